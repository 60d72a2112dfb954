"""Top-k reports, logs read back, and URL bookkeeping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linksift.constants import UNCERTAIN_HIGH, UNCERTAIN_LOW, URL_SHORTENERS


def active_queue(scored: DataFrame, score_col: str = "score", arrival: str = "id", k: int = 20) -> DataFrame:
    """The k most uncertain rows of the band 0.35..0.65 (earlier arrival first on ties)."""
    p = F.col(score_col)
    return (
        scored.filter(p.between(UNCERTAIN_LOW, UNCERTAIN_HIGH))
        .withColumn("uncertainty", 1.0 - F.abs(p - 0.5) * 2.0)
        .orderBy(F.desc("uncertainty"), arrival)
        .limit(k)
    )


def recent_predictions(log: DataFrame, n: int = 100) -> DataFrame:
    """Newest predictions first."""
    return (
        log.orderBy(F.desc("ts"), F.desc("id"))
        .limit(n)
        .select("ts", "url", "prob", "prediction", "risk", "source")
    )


def recent_urls(log: DataFrame, n: int = 30) -> DataFrame:
    """The n URLs seen last, each once."""
    return log.groupBy("url").agg(F.max("ts").alias("ts")).orderBy(F.desc("ts"), "url").limit(n)


def hourly_verdicts(log: DataFrame) -> DataFrame:
    """(hour, prediction, n) over the prediction log."""
    return log.groupBy(F.window("ts", "1 hour").alias("w"), "prediction").agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("hour"), "prediction", "n"
    )


def live_counters(log: DataFrame, online_samples: int, threshold: float, model_hash: str) -> DataFrame:
    """One row: predictions, positives, waiting uncertain rows, learned samples, threshold, model."""
    return log.agg(
        F.count("*").alias("predictions"),
        F.count_if(F.col("prediction") == 1).alias("positives"),
        F.count_if(F.col("prob").between(UNCERTAIN_LOW, UNCERTAIN_HIGH)).alias("queue_length"),
        F.lit(online_samples).cast("long").alias("online_samples"),
        F.lit(threshold).alias("threshold"),
        F.lit(model_hash).alias("model_hash"),
    )


def unseen_urls(urls: DataFrame, log: DataFrame) -> DataFrame:
    """Distinct URLs that the log does not hold.

    Both sides are made distinct first (partial aggregation folds copies), so no
    hot URL reaches the join.
    """
    return urls.select("url").distinct().join(log.select("url").distinct(), "url", "left_anti")


def from_shorteners(parsed: DataFrame, host_col: str = "u_host") -> DataFrame:
    """Rows whose host is a known shortener (a fixed list: a filter, not a join)."""
    return parsed.filter(F.col(host_col).isin(*URL_SHORTENERS))


def feedback_join(feedback: DataFrame, features: Callable[[DataFrame], DataFrame], columns: list[str]) -> DataFrame:
    """Feedback with features of the same URL.

    ``features`` makes the feature frame of a frame of URLs; it sees the URLs that
    were fed back, each once. Feedback that repeats one URL is split by AQE's skew join.
    """
    once = features(feedback.select("url").distinct()).select("url", *columns)
    return feedback.join(once, "url", "left")
