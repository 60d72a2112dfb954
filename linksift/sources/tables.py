"""Readers: URL lines, rules files, watchlists, feedback and the given parquet tables."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linksift.functions.text import strip
from linksift.operators.reasons import default_rules, rules_with_defaults

log = logging.getLogger("linksift")

# Line ends next to LF and CR.
LINE_ENDS = "[\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
_MEANWHILE = "\ufdd0"


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Give every core a share of an input that comes in fewer pieces than there are cores.

    A large input has more file splits than cores and is left as it is, without
    a shuffle. A small file is one piece, whatever work follows on its rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *key) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """At most about ``rows`` rows of a cheaply counted input in a task, and a task for each core at least.

    For inputs whose rows become many, or cost much each: their file splits go by bytes, so
    a task's work would grow with the input and be uneven.
    """
    session = df.sparkSession
    tasks = max(session.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(tasks, *key) if df.rdd.getNumPartitions() < tasks else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """One trimmed URL per non-blank line. Bytes that are no UTF-8 are dropped.

    Lines also end at the other line ends of Unicode and ASCII. A replacement character
    that stands in the input stays: a noncharacter keeps its place meanwhile.
    """
    kept = F.replace(F.col(col), F.lit("\ufffd"), F.lit(_MEANWHILE))
    text = F.replace(F.replace(F.make_valid_utf8(kept), F.lit("\ufffd"), F.lit("")), F.lit(_MEANWHILE), F.lit("\ufffd"))
    rest = [c for c in lines.columns if c != col]
    return lines.select(*rest, F.explode(F.split(text, LINE_ENDS)).alias("url")).select(*rest, strip(F.col("url")).alias("url")).filter("url <> ''")


def url_lines(spark: SparkSession, path: str | list[str], inline: list[str] = ()) -> DataFrame:
    """URLs of text files (``.txt``, or ``.csv`` taken as plain lines), after the inline ones."""
    found = clean_lines(spark.read.text(path))
    if not inline:
        return found
    first = spark.createDataFrame([(u,) for u in inline], "value string")
    return clean_lines(first).unionByName(found)


def read_rules(spark: SparkSession, path: str | None) -> DataFrame:
    """Rules of a JSON file ``{"rules": [...]}``; the default rules if it is absent, empty or broken."""
    if path is None:
        return default_rules(spark)
    try:
        raw = spark.read.option("multiLine", True).option("mode", "FAILFAST").json(path)
        rules = rules_with_defaults(raw.select(F.inline("rules")))
        if rules.isEmpty():
            return default_rules(spark)
        return rules
    except (PySparkException, Py4JError) as exc:
        log.warning("rules not read, defaults taken: %s", type(exc).__name__)
        return default_rules(spark)


def read_watchlist(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a JSON list of strings."""
    text = spark.read.text(path, wholetext=True)
    entries = F.explode(F.from_json("value", "array<string>"))
    return text.select(entries.alias("entry")).select(F.lower(strip(F.col("entry"))).alias("entry")).filter("entry <> ''")
