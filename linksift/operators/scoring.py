"""From a probability to a verdict, a risk number and a conformal set; the batch scan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linksift.constants import ALERT_RISK, FEATURES
from linksift.functions.stages import staged
from linksift.operators import reasons as R
from linksift.operators.parse import PART_COLUMNS, with_tokens, with_url_features

PROBABILITY_FLOOR = 1e-9


def clipped(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(PROBABILITY_FLOOR)), F.lit(1 - PROBABILITY_FLOOR))


# ----------------------------------------------------------------- risk ----


def risk_input(prob: Column, reason_sum: Column, rule_sum: Column) -> Column:
    """The number that the risk calibrator maps to 0..1."""
    return 0.6 * prob + 0.25 * F.tanh(reason_sum / 5.0) + 0.15 * F.tanh(rule_sum / 5.0)


def plain_risk(prob: Column, reason_sum: Column) -> Column:
    """Risk 0..100 without a calibrator, rounded half to even."""
    score = F.bround(100 * (0.6 * prob + 0.4 * F.tanh(reason_sum / 5.0)), 0)
    return F.least(F.lit(100), score.cast("int"))


def fit_risk(df: DataFrame) -> IsotonicRegressionModel:
    """Isotonic fit of ``label`` on the risk input of columns probability, reason_sum, rule_sum."""
    z = risk_input(F.col("probability"), F.col("reason_sum"), F.col("rule_sum"))
    # equal inputs are merged first: the same fit from far fewer rows
    points = df.groupBy(z.alias("z")).agg(
        F.avg(F.col("label").cast("double")).alias("y"), F.count("*").cast("double").alias("w")
    )
    return IsotonicRegression(featuresCol="z", labelCol="y", weightCol="w", predictionCol="risk_p").fit(points)


def with_risk(df: DataFrame, model: IsotonicRegressionModel | None = None) -> DataFrame:
    """Add ``risk`` from probability, reason_sum and rule_sum."""
    prob, reason_sum, rule_sum = F.col("probability"), F.col("reason_sum"), F.col("rule_sum")
    if model is None:
        return df.withColumn("risk", plain_risk(prob, reason_sum))
    mapped = model.transform(df.withColumn("z", risk_input(prob, reason_sum, rule_sum)))
    p = F.least(F.greatest(F.col("risk_p"), F.lit(0.0)), F.lit(1.0))
    return mapped.withColumn("risk", F.bround(p * 100, 0).cast("int")).drop("z", "risk_p")


# ------------------------------------------------------------ conformal ----


def with_conformal(df: DataFrame, q: float | None) -> DataFrame:
    """Add conformal_0, conformal_1, conformal_p and abstain; without ``q`` both are in and p is 1."""
    if q is None:
        return df.withColumns(
            {
                "conformal_0": F.lit(True),
                "conformal_1": F.lit(True),
                "conformal_p": F.lit(1.0),
                "abstain": F.lit(False),
            }
        )
    p = clipped(F.col("probability"))
    zero, one = p <= q, (F.lit(1.0) - p) <= q
    return df.withColumns({"conformal_0": zero, "conformal_1": one, "conformal_p": p, "abstain": zero & one})


def display_label() -> Column:
    return F.when(F.col("abstain"), "ABSTAIN").otherwise(F.when(F.col("verdict") == 1, "PHISHING").otherwise("CLEAN"))


def conformal_label() -> Column:
    zero, one = F.col("conformal_0"), F.col("conformal_1")
    return F.when(zero & one, "both").when(one, "phish").when(zero, "clean").otherwise("∅")


# ----------------------------------------------------------------- scan ----


@dataclass(frozen=True)
class Scorer:
    """What a scan needs to turn features into verdicts.

    ``score`` adds a ``probability`` column to a frame with the 50 features; it
    may also add ``contributions`` and ``base_value``.
    """

    score: Callable[[DataFrame], DataFrame] | None = None
    threshold: float = 0.5
    conformal_q: float | None = None
    risk_model: IsotonicRegressionModel | None = None
    online: Callable[[DataFrame], DataFrame] | None = None
    model_hash: str = ""


SCAN_COLUMNS = (
    "url", "probability", "verdict", "risk", "reasons", *FEATURES, "flags", "tokens", "contributions",
    "base_value", "conformal_set", "conformal_p", "abstain", "online_prob", "error", "model_hash", "source",
)


def scan(
    df: DataFrame,
    scorer: Scorer = Scorer(),
    rules: DataFrame | None = None,
    watchlist: DataFrame | None = None,
    source: str = "batch",
    url_col: str = "url",
) -> DataFrame:
    """Score every URL of ``df``: one projection pipeline, no shuffle.

    Other columns of ``df`` pass through in front. Rows that cannot be parsed
    come out with probability, verdict and risk 0 and the error as only reason.
    ``rules=None`` scores without rules.
    """
    # a user's column with the name of an output column gives way, except the url
    carried = [c for c in df.columns if c == url_col or c not in SCAN_COLUMNS]
    if url_col != "url":
        df = df.withColumnRenamed(url_col, "url")
        carried = ["url" if c == url_col else c for c in carried]
    rest = [c for c in carried if c != "url"]
    out = with_tokens(with_url_features(df.select(*carried), "url", keep_parts=True))
    out = R.with_heuristics(out)
    out = R.apply_rules(out, rules) if rules is not None else out.withColumn(
        "rule_reasons", F.array().cast(f"array<{R.REASON_TYPE}>")
    )
    drop = [c for c in PART_COLUMNS]
    out = staged(
        out.withColumn("reasons", F.concat("heuristic_reasons", "rule_reasons")),
        reason_sum=R.reason_sum(F.col("reasons")),
        rule_sum=R.weight_sum(F.col("rule_reasons")),
    ).drop(*drop, "heuristic_reasons", "rule_reasons")

    out = scorer.score(out) if scorer.score is not None else out.withColumn("probability", F.lit(0.5))
    if "contributions" not in out.columns:
        out = out.withColumn("contributions", F.create_map().cast("map<string,double>"))
    if "base_value" not in out.columns:
        out = out.withColumn("base_value", F.lit(0.0))
    out = with_conformal(with_risk(out, scorer.risk_model), scorer.conformal_q)
    if scorer.online is not None:
        out = scorer.online(out)
    else:
        out = out.withColumn("online_prob", F.lit(None).cast("double"))

    ok = F.col("error").isNull()
    out = out.withColumns(
        {
            "verdict": F.when(ok & (F.col("probability") >= scorer.threshold), 1).otherwise(0),
            "probability": F.when(ok, F.col("probability")).otherwise(0.0),
            "risk": F.when(ok, F.col("risk")).otherwise(0),
            "conformal_0": F.col("conformal_0") | ~ok,
            "conformal_1": F.col("conformal_1") | ~ok,
            "conformal_p": F.when(ok, F.col("conformal_p")).otherwise(1.0),
            "abstain": F.col("abstain") & ok,
            "online_prob": F.when(ok, F.col("online_prob")),
            "contributions": F.when(ok, F.col("contributions")).otherwise(
                F.create_map().cast("map<string,double>")
            ),
            "base_value": F.when(ok, F.col("base_value")).otherwise(0.0),
        }
    )
    if watchlist is not None:
        hit = F.col("watch_hit")
        out = R.apply_watchlist(out, watchlist, urls=df).withColumns(
            {
                "reasons": F.when(hit, F.concat("reasons", F.array(R.watch_reason()))).otherwise(F.col("reasons")),
                "risk": F.when(hit, 100).otherwise(F.col("risk")),
                "verdict": F.when(hit, 1).otherwise(F.col("verdict")),
                "abstain": F.col("abstain") & ~hit,
            }
        )
    return out.withColumns(
        {
            "conformal_set": F.struct(F.col("conformal_0").alias("clean"), F.col("conformal_1").alias("phishing")),
            "model_hash": F.lit(scorer.model_hash),
            "source": F.lit(source),
        }
    ).select(*rest, *SCAN_COLUMNS)


def alerts(scored: DataFrame, min_risk: int = ALERT_RISK) -> DataFrame:
    """High-risk rows: url, probability, risk, prediction and the first five reason texts."""
    return scored.filter(F.col("risk") >= min_risk).select(
        "url",
        "probability",
        "risk",
        F.col("verdict").alias("prediction"),
        F.transform(F.slice("reasons", 1, 5), lambda r: r["text"]).alias("reasons"),
    )


def score_distinct(df: DataFrame, score: Callable[[DataFrame], DataFrame], url_col: str = "url") -> DataFrame:
    """Score each distinct URL once and give the result to all its rows.

    Only for costly scorers. The distinct step pre-aggregates per partition, so
    a URL that fills a third of the rows shuffles as one row per partition; on
    the way back AQE splits the skewed side of the join.
    """
    once = score(df.select(url_col).distinct())
    return df.join(once, url_col, "left")
