"""Population stability index between a reference and a current table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linksift.constants import CONTINUOUS_FEATURES, PSI_ALERT, PSI_WARN
from linksift.operators.ranked import exact_quantiles

MIN_ROWS = 10
MIN_EDGES = 3
EDGE_MARGIN = 1e-9
SHARE_FLOOR = 1e-6


def reference_edges(ref: DataFrame, columns: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Distinct quantile edges per column (columns x bins numbers), outer edges moved out a little."""
    probs = [i / bins for i in range(bins + 1)]
    found: dict[str, set[float]] = {c: set() for c in columns}
    for r in exact_quantiles(ref, columns, probs).collect():
        if r.n >= MIN_ROWS:
            found[r.feature].add(r.value)
    edges = {}
    for c, values in found.items():
        e = sorted(values)
        if len(e) >= MIN_EDGES:
            edges[c] = [e[0] - EDGE_MARGIN, *e[1:-1], e[-1] + EDGE_MARGIN]
    return edges


def _bin(value: Column, edges: list[float]) -> Column:
    """0-based bin, closed left and open right, the last one closed; NULL outside."""
    at_least = sum((F.when(value >= e, 1).otherwise(0) for e in edges), F.lit(0))
    last = len(edges) - 2
    return (
        F.when(value.isNull() | F.isnan(value) | (at_least == 0), F.lit(None).cast("int"))
        .when(at_least <= last + 1, at_least - 1)
        .when(value == edges[-1], F.lit(last))
    )


def _binned(df: DataFrame, edges: dict[str, list[float]], columns: Sequence[str], side: str) -> DataFrame:
    """(feature, side, bin, n): one row per bin leaves each task before the shuffle. bin -1: outside."""
    entries = []
    for c in columns:
        value = F.col(c).cast("double")
        place = _bin(value, edges[c]) if c in edges else F.lit(None).cast("int")
        entries.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.lit(side).alias("side"),
                F.when(value.isNotNull() & ~F.isnan(value), F.coalesce(place, F.lit(-1))).alias("bin"),
            )
        )
    return df.select(F.inline(F.array(*entries))).filter("bin IS NOT NULL").groupBy("feature", "side", "bin").agg(
        F.count("*").alias("n")
    )


def psi(ref: DataFrame, cur: DataFrame, columns: Sequence[str] = CONTINUOUS_FEATURES, bins: int = 10) -> DataFrame:
    """(feature, psi). 0 where a side has fewer than ten values or the edges collapse."""
    spark = ref.sparkSession
    columns = list(columns)
    edges = reference_edges(ref, columns, bins)
    both = _binned(ref, edges, columns, "ref").unionByName(_binned(cur, edges, columns, "cur"))
    # all bins of all features, also the empty ones: columns x bins rows
    layout = [(c, b) for c in columns for b in range(max(1, len(edges.get(c, [])) - 1))]
    frame = spark.createDataFrame(layout, "feature string, bin int")
    n = F.col("n")
    wide = both.groupBy("feature", "bin").agg(
        F.sum(F.when(F.col("side") == "ref", n)).alias("ref_n"), F.sum(F.when(F.col("side") == "cur", n)).alias("cur_n")
    )
    sizes = wide.groupBy("feature").agg(
        F.sum("ref_n").alias("ref_all"),
        F.sum("cur_n").alias("cur_all"),
        F.sum(F.when(F.col("bin") >= 0, F.col("ref_n"))).alias("ref_in"),
        F.sum(F.when(F.col("bin") >= 0, F.col("cur_n"))).alias("cur_in"),
    )

    def share(part: str, whole: str) -> Column:
        return F.greatest(F.coalesce(part, F.lit(0)) / F.greatest(F.coalesce(whole, F.lit(0)), F.lit(1)), F.lit(SHARE_FLOOR))

    r, c = share("ref_n", "ref_in"), share("cur_n", "cur_in")
    usable = (
        F.col("feature").isin(*edges) if edges else F.lit(False)
    ) & (F.coalesce("ref_all", F.lit(0)) >= MIN_ROWS) & (F.coalesce("cur_all", F.lit(0)) >= MIN_ROWS)
    return (
        frame.join(wide, ["feature", "bin"], "left")
        .join(sizes, "feature", "left")
        .groupBy("feature")
        .agg(F.sum(F.when(usable, (c - r) * F.log(c / r)).otherwise(0.0)).alias("psi"))
    )


def drift_report(
    ref: DataFrame,
    cur: DataFrame,
    columns: Sequence[str] = CONTINUOUS_FEATURES,
    warn: float = PSI_WARN,
    alert: float = PSI_ALERT,
    bins: int = 10,
) -> DataFrame:
    """(feature, psi, status), largest first, led by the row ``_max_psi``. Error rows do not count."""

    def valid(df: DataFrame) -> DataFrame:
        return df.filter(F.col("error").isNull()) if "error" in df.columns else df

    per_feature = psi(valid(ref), valid(cur), columns, bins)
    # rollup gives the overall maximum in the same pass
    value = F.max("psi")
    status = F.when(F.col("psi") >= alert, "ALERT").when(F.col("psi") >= warn, "warn").otherwise("ok")
    return (
        per_feature.rollup("feature")
        .agg(value.alias("psi"))
        .select(F.coalesce("feature", F.lit("_max_psi")).alias("feature"), "psi", status.alias("status"))
        .orderBy(F.desc("psi"), "feature")
    )
