"""Evaluation of a scored table with columns ``label`` (0/1) and ``score``."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linksift.operators.ranked import (
    INF,
    cumulative_counts,
    exact_quantiles,
    order_statistics,
    score_counts,
)
from linksift.operators.scoring import clipped

# The threshold grid and the number of reliability bins.
GRID_STEPS = np.linspace(0.02, 0.98, 49).tolist()
GRID_QUANTILES = np.linspace(0.01, 0.99, 33).tolist()
RELIABILITY_BINS = 12


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def cell_metrics(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Metrics of a confusion table; a zero division gives 0."""
    tn, fp, fn, tp = (c.cast("double") for c in (tn, fp, fn, tp))
    n_pos, n_neg = tp + fn, tn + fp
    recall, specificity = _ratio(tp, n_pos), _ratio(tn, n_neg)
    balanced = (
        F.when((n_pos > 0) & (n_neg > 0), (recall + specificity) / 2)
        .when(n_pos > 0, recall)
        .otherwise(specificity)
    )
    # square roots one by one: the product of the four sums would lose digits
    spread = F.sqrt(tp + fp) * F.sqrt(n_pos) * F.sqrt(n_neg) * F.sqrt(tn + fn)
    return {
        "accuracy": _ratio(tp + tn, n_pos + n_neg),
        "balanced_accuracy": balanced,
        "precision": _ratio(tp, tp + fp),
        "recall": recall,
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "mcc": _ratio(tp * tn - fp * fn, spread),
    }


def confusion(scored: DataFrame, threshold: float) -> DataFrame:
    """One row tn, fp, fn, tp; ``score >= threshold`` counts as positive."""
    yes, hit = F.col("label") == 1, F.col("score") >= threshold
    return scored.agg(
        F.count_if(~yes & ~hit).alias("tn"),
        F.count_if(~yes & hit).alias("fp"),
        F.count_if(yes & ~hit).alias("fn"),
        F.count_if(yes & hit).alias("tp"),
    )


def _auc_terms() -> tuple[Column, Column]:
    """Per score step: its part of the ROC area (trapezoid) and of the average precision."""
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    n_pos, n_neg = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    return neg * (tp - pos / 2) / (n_pos * n_neg), pos / n_pos * tp / (tp + fp)


def binary_metrics(scored: DataFrame, threshold: float) -> DataFrame:
    """One row with the ten point metrics and the four cells.

    All of them are sums over the counts per distinct score; the ranges of scores are
    found first, so the input is read for them as well.
    """
    eps = sys.float_info.epsilon
    s, pos, neg = F.col("score").cast("double"), F.col("pos"), F.col("neg")
    safe = F.least(F.greatest(s, F.lit(eps)), F.lit(1 - eps))
    area, step = _auc_terms()
    hit = s >= threshold
    sums = cumulative_counts(scored).agg(
        F.sum(F.when(hit, 0).otherwise(neg)).alias("tn"),
        F.sum(F.when(hit, neg).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(pos)).alias("fn"),
        F.sum(F.when(hit, pos).otherwise(0)).alias("tp"),
        F.sum(area).alias("roc_auc"),
        F.sum(step).alias("pr_auc"),
        (F.sum(pos * F.pow(1 - s, 2.0) + neg * F.pow(s, 2.0)) / F.sum(pos + neg)).alias("brier"),
        (-F.sum(pos * F.log(safe) + neg * F.log(1 - safe)) / F.sum(pos + neg)).alias("log_loss"),
    )
    cells = cell_metrics(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    return sums.select(
        *[c.alias(name) for name, c in cells.items()],
        "roc_auc", "pr_auc", "brier", "log_loss", "tn", "fp", "fn", "tp",
    )


def roc_auc(scored: DataFrame) -> DataFrame:
    return cumulative_counts(scored).agg(F.sum(_auc_terms()[0]).alias("roc_auc"))


def average_precision(scored: DataFrame) -> DataFrame:
    """Sum of (R_n - R_n-1) * P_n, without interpolation."""
    return cumulative_counts(scored).agg(F.sum(_auc_terms()[1]).alias("avg_precision"))


def roc_curve(scored: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) from (inf, 0, 0) on; points on a straight line between others may be dropped."""
    counts = cumulative_counts(scored)
    if drop_intermediate:
        corner = (
            F.col("first")
            | F.col("next_pos").isNull()
            | (F.col("next_pos") != F.col("pos"))
            | (F.col("next_neg") != F.col("neg"))
        )
        counts = counts.filter(corner)
    # the start is added next to the first point: no second pass over the input
    point = F.struct(
        F.col("score").cast("double").alias("threshold"),
        (F.col("fp") / F.col("n_neg")).alias("fpr"),
        (F.col("tp") / F.col("n_pos")).alias("tpr"),
    )
    start = F.struct(F.lit(INF).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return counts.select(F.inline(F.when(F.col("first"), F.array(start, point)).otherwise(F.array(point))))


def pr_curve(scored: DataFrame) -> DataFrame:
    """(threshold, recall, precision) per distinct score, and the end point (NULL, 0, 1)."""
    point = F.struct(
        F.col("score").cast("double").alias("threshold"),
        (F.col("tp") / F.col("n_pos")).alias("recall"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
    )
    end = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision")
    )
    return cumulative_counts(scored).select(
        F.inline(F.when(F.col("first"), F.array(point, end)).otherwise(F.array(point)))
    )


# ------------------------------------------------------------ thresholds ----


def threshold_grid(scored: DataFrame) -> list[float]:
    """Fixed steps and score quantiles, sorted and unique (at most 82 numbers)."""
    quantiles = exact_quantiles(scored, ["score"], GRID_QUANTILES).select("value").collect()
    return sorted({*GRID_STEPS, *(r.value for r in quantiles)})


def scan_thresholds(scored: DataFrame, cost_fn: float = 10.0, cost_fp: float = 1.0) -> DataFrame:
    """Metrics at every grid threshold.

    Each row is placed once in the grid (binary search) and counted; the at most
    83 counts are then summed from the top. ``threshold`` is the exact grid
    value, ``threshold_shown`` the one rounded to four places.
    """
    spark = scored.sparkSession
    grid = threshold_grid(scored)
    placed = Bucketizer(splits=[-INF, *grid, INF], inputCol="s", outputCol="slot").transform(
        score_counts(scored).select(F.col("score").cast("double").alias("s"), "pos", "neg")
    )
    per_slot = placed.groupBy(F.col("slot").cast("int").alias("slot")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    slots = spark.createDataFrame([(0, None), *((i + 1, t) for i, t in enumerate(grid))], "slot int, threshold double")
    from_top = W.orderBy(F.desc("slot"))
    everything = W.partitionBy()
    counted = slots.join(per_slot, "slot", "left").select(
        "slot",
        "threshold",
        F.sum(F.coalesce("pos", F.lit(0))).over(from_top).alias("tp"),
        F.sum(F.coalesce("neg", F.lit(0))).over(from_top).alias("fp"),
        F.sum(F.coalesce("pos", F.lit(0))).over(everything).alias("n_pos"),
        F.sum(F.coalesce("neg", F.lit(0))).over(everything).alias("n_neg"),
    )
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("n_pos") - tp, F.col("n_neg") - fp
    m = cell_metrics(tn, fp, fn, tp)
    youden = tp / F.greatest(F.col("n_pos"), F.lit(1)) - fp / F.greatest(F.col("n_neg"), F.lit(1))
    return counted.filter("slot > 0").select(
        "threshold",
        F.round("threshold", 4).alias("threshold_shown"),
        m["precision"].alias("precision"),
        m["recall"].alias("recall"),
        m["f1"].alias("f1"),
        m["balanced_accuracy"].alias("balanced_accuracy"),
        m["mcc"].alias("mcc"),
        youden.alias("youden_j"),
        fp.alias("fp"),
        fn.alias("fn"),
        (cost_fn * fn + cost_fp * fp).alias("expected_cost"),
    )


# Criterion name, scan column, direction.
CRITERIA = (
    ("f1", "f1", "max"),
    ("cost", "expected_cost", "min"),
    ("youden", "youden_j", "max"),
    ("balanced", "balanced_accuracy", "max"),
    ("mcc", "mcc", "max"),
)


def select_thresholds(scan: DataFrame) -> DataFrame:
    """(criterion, threshold, threshold_shown): the best per criterion, the lowest threshold on ties."""
    picks = []
    for _, column, direction in CRITERIA:
        key = F.col(column) if direction == "min" else -F.col(column)
        picks.append(F.min(F.struct(key.alias("k"), F.col("threshold"), F.col("threshold_shown"))))
    best = scan.agg(*[p.alias(name) for p, (name, _, _) in zip(picks, CRITERIA)])
    return best.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("criterion"),
                        F.col(name)["threshold"].alias("threshold"),
                        F.col(name)["threshold_shown"].alias("threshold_shown"),
                    )
                    for name, _, _ in CRITERIA
                ]
            )
        )
    )


def calibration_curve(scored: DataFrame, bins: int = RELIABILITY_BINS) -> DataFrame:
    """(bin, mean_score, frac_pos, n) over quantile bins; a bin holds the scores above its lower edge."""
    probs = [i / bins for i in range(1, bins)]
    inner = [r.value for r in exact_quantiles(scored, ["score"], probs).select("value").collect()]
    place = sum((F.when(F.col("score") > e, 1).otherwise(0) for e in inner), F.lit(0))
    return scored.groupBy(place.alias("bin")).agg(
        F.avg(F.col("score").cast("double")).alias("mean_score"),
        F.avg(F.col("label").cast("double")).alias("frac_pos"),
        F.count("*").alias("n"),
    )


# ------------------------------------------------------------- conformal ----


def conformal_fit(scored: DataFrame, alpha: float = 0.10) -> DataFrame:
    """One row (q, n): the k-th smallest nonconformity, k = ceil((n+1)(1-alpha)) inside 1..n; q = 1 when empty."""
    p = clipped(F.col("score").cast("double"))
    strange = scored.select(F.when(F.col("label") == 1, 1 - p).otherwise(p).alias("score"))

    def rank(n: Column) -> Column:
        k = F.ceil((n + 1) * F.lit(1 - alpha)).cast("long")
        r = F.least(F.greatest(k, F.lit(1)), n) - 1
        return F.array(F.struct(F.lit(0.0).alias("prob"), F.lit(0.0).alias("share"), r.alias("low"), r.alias("high")))

    found = order_statistics(strange, ["score"], rank)
    return found.agg(
        F.coalesce(F.max("value"), F.lit(1.0)).alias("q"), F.coalesce(F.max("n"), F.lit(0)).alias("n")
    )


def conformal_sets(scored: DataFrame, q: float) -> DataFrame:
    """Add in0, in1 and abstain."""
    p = clipped(F.col("score").cast("double"))
    in0, in1 = p <= q, (1 - p) <= q
    return scored.withColumns({"in0": in0, "in1": in1, "abstain": in0 & in1})


def conformal_coverage(scored: DataFrame, q: float) -> DataFrame:
    """(coverage, size): share of sets that hold the truth, mean set size; 0 when empty."""
    truth = F.when(F.col("label") == 1, F.col("in1")).otherwise(F.col("in0"))
    return conformal_sets(scored, q).agg(
        F.coalesce(F.avg(truth.cast("double")), F.lit(0.0)).alias("coverage"),
        F.coalesce(F.avg((F.col("in0").cast("int") + F.col("in1").cast("int")).cast("double")), F.lit(0.0)).alias("size"),
    )


def dataset_counts(df: DataFrame, by: list[str] = ()) -> DataFrame:
    return df.groupBy(*by, "label").agg(F.count("*").alias("n"))


MetricOfCells = Callable[[Column, Column, Column, Column], Column]
