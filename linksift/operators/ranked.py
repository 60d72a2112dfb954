"""Exact order statistics and running totals that no single task has to hold.

A global ``Window.orderBy`` or an exact ``percentile`` brings all distinct values
into one task. Here values are first counted per distinct value (partial
aggregation folds hot values before the shuffle), then cut into ranges of about
equal size. Running totals are taken inside each range, and only the totals of
the ranges - one row per range - are summed in order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

INF = float("inf")


def range_count(df: DataFrame) -> int:
    """How many ranges to cut into: one per shuffle partition."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def range_edges(df: DataFrame, columns: Sequence[str], ranges: int | None = None) -> list[list[float]]:
    """Inner edges of near-equal ranges per column, from one pass with a bounded sketch.

    The edges need not be exact: they only balance the work.
    """
    ranges = ranges or range_count(df)
    probs = [i / ranges for i in range(1, ranges)]
    found = df.approxQuantile(list(columns), probs, 1.0 / (4 * ranges))
    # a column without values still needs one edge
    return [sorted(set(e)) or [0.0] for e in found]


def with_range(df: DataFrame, columns: Sequence[str], edges: list[list[float]], outputs: Sequence[str]) -> DataFrame:
    """Add the range number of each value, by binary search over the edges."""
    return Bucketizer(
        splitsArray=[[-INF, *e, INF] for e in edges],
        inputCols=list(columns),
        outputCols=list(outputs),
        handleInvalid="keep",
    ).transform(df)


def _quantile_ranks(n: Column, probs: Sequence[float]) -> Column:
    """For linear interpolation: the two ranks around (n-1)*q and the share of the upper one."""
    entries = []
    for q in probs:
        h = (n - 1) * F.lit(float(q))
        low = F.floor(h).cast("long")
        entries.append(
            F.struct(
                F.lit(float(q)).alias("prob"),
                (h - low).alias("share"),
                low.alias("low"),
                F.least(low + 1, n - 1).alias("high"),
            )
        )
    return F.array(*entries)


def order_statistics(df: DataFrame, columns: Sequence[str], ranks: Callable[[Column], Column]) -> DataFrame:
    """(feature, n, prob, value): values at given ranks of each column; NULL and NaN do not count.

    ``ranks`` maps the count column to ARRAY<STRUCT<prob, share, low, high>>
    (0-based ranks); the value is interpolated between ranks low and high.
    """
    columns = list(columns)
    data = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    # Bucketizer refuses nothing with "keep"; NULLs are dropped after the unpivot
    ranged = with_range(data, columns, range_edges(data, columns), [f"_r_{c}" for c in columns])
    entries = [F.struct(F.lit(c).alias("feature"), F.col(f"_r_{c}").cast("int").alias("rng"), F.col(c).alias("value")) for c in columns]
    counts = (
        ranged.select(F.inline(F.array(*entries)))
        .filter("value IS NOT NULL")
        .groupBy("feature", "rng", "value")
        .agg(F.count("*").alias("n"))
    )
    # one row per feature and range
    sizes = counts.groupBy("feature", "rng").agg(F.sum("n").alias("size"))
    ordered = W.partitionBy("feature").orderBy("rng")
    placed = sizes.select(
        "feature",
        "rng",
        "size",
        (F.sum("size").over(ordered) - F.col("size")).alias("before"),
        F.sum("size").over(W.partitionBy("feature")).alias("n"),
    )
    wanted = (
        placed.select("*", F.explode(ranks(F.col("n"))).alias("t"))
        .select("feature", "rng", "n", "before", "size", "t.prob", "t.share",
                F.explode(F.array(
                    F.struct(F.lit(0).alias("side"), F.col("t.low").alias("rank")),
                    F.struct(F.lit(1).alias("side"), F.col("t.high").alias("rank")),
                )).alias("w"))
        .select("*", "w.side", (F.col("w.rank") - F.col("before")).alias("rank"))
        .filter("rank >= 0 AND rank < size")
        .select("feature", F.col("rng"), F.col("n").alias("total"), "prob", "share", "side", "rank")
    )
    # at most two rows per feature and rank: small by construction, so it is broadcast
    touched = counts.join(F.broadcast(wanted.select("feature", "rng").distinct()), ["feature", "rng"], "left_semi")
    inside = W.partitionBy("feature", "rng").orderBy("value")
    running = touched.select("feature", "rng", "value", "n", F.sum("n").over(inside).alias("upto"))
    hit = running.join(F.broadcast(wanted), ["feature", "rng"]).filter("rank < upto AND rank >= upto - n")
    low, high, share = (F.col(c) for c in ("low", "high", "share"))
    return (
        hit.groupBy("feature", "total", "prob", "share")
        .agg(
            F.max(F.when(F.col("side") == 0, F.col("value"))).alias("low"),
            F.max(F.when(F.col("side") == 1, F.col("value"))).alias("high"),
        )
        .select(
            "feature",
            F.col("total").alias("n"),
            "prob",
            F.when(share >= 0.5, high - (high - low) * (1 - share)).otherwise(low + (high - low) * share).alias("value"),
        )
    )


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(feature, n, prob, value): exact quantiles with linear interpolation."""
    return order_statistics(df, columns, lambda n: _quantile_ranks(n, probs))


def score_counts(scored: DataFrame) -> DataFrame:
    """(score, pos, neg): labels counted per distinct score."""
    label = F.col("label")
    # A generated row, of one element: the joins made later are on a number derived
    # from the score, and the planner would trace that number back through every
    # stage that led to the score to look for filters. It stops at a generator.
    pairs = scored.select(F.inline(F.array(F.struct(F.col("score").alias("score"), label.alias("label")))))
    return pairs.groupBy("score").agg(
        F.sum(F.when(label == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(label == 1, 0).otherwise(1)).alias("neg"),
    )


def cumulative_counts(scored: DataFrame) -> DataFrame:
    """One row per distinct score, from high to low, with running totals.

    Columns: score, pos, neg, tp, fp (positives and negatives at or above the
    score), n_pos, n_neg (totals), next_pos, next_neg (counts at the next lower
    score), first (the highest score).
    """
    edges = range_edges(scored.select(F.col("score").cast("double")), ["score"])
    counts = with_range(score_counts(scored), ["score"], edges, ["rng"])
    # one row per range
    totals = counts.groupBy("rng").agg(
        F.sum("pos").alias("r_pos"),
        F.sum("neg").alias("r_neg"),
        F.max_by(F.struct("pos", "neg"), "score").alias("top"),
    )
    down = W.orderBy(F.desc("rng"))
    everything = W.partitionBy()
    offsets = totals.select(
        "rng",
        (F.sum("r_pos").over(down) - F.col("r_pos")).alias("before_pos"),
        (F.sum("r_neg").over(down) - F.col("r_neg")).alias("before_neg"),
        F.sum("r_pos").over(everything).alias("n_pos"),
        F.sum("r_neg").over(everything).alias("n_neg"),
        F.lead("top").over(down).alias("next_top"),
        F.lag("rng").over(down).isNull().alias("top_range"),
    )
    inside = W.partitionBy("rng").orderBy(F.desc("score"))
    local = counts.select(
        "score", "pos", "neg", "rng",
        F.sum("pos").over(inside).alias("l_pos"),
        F.sum("neg").over(inside).alias("l_neg"),
        F.lead(F.struct("pos", "neg")).over(inside).alias("l_next"),
        F.row_number().over(inside).alias("l_row"),
    )
    following = F.coalesce(F.col("l_next"), F.col("next_top"))
    return local.join(F.broadcast(offsets), "rng").select(
        "score", "pos", "neg",
        (F.col("before_pos") + F.col("l_pos")).alias("tp"),
        (F.col("before_neg") + F.col("l_neg")).alias("fp"),
        "n_pos", "n_neg",
        following["pos"].alias("next_pos"),
        following["neg"].alias("next_neg"),
        (F.col("top_range") & (F.col("l_row") == 1)).alias("first"),
    )
