"""Tables the registered queries work on, all derived from the given parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linksift.config import JobConfig
from linksift.constants import SIMILARITY_FREE_SCORE
from linksift.operators import models as M
from linksift.operators.explain import NODE_SCHEMA
from linksift.operators.parse import with_url_features
from linksift.operators.reasons import RULES_SCHEMA, default_rules
from linksift.operators.registry import REGISTRY_SCHEMA
from linksift.plans.train import labelled_features
from linksift.session import written
from linksift.sources.corpus import url_corpus
from linksift.sources.tables import table

# The published settings but for the sizes of the tree ensembles, which are 12 trees of
# depth 6 (published: 300 of depth 16) and 8 boosting rounds (published: 400).
QUICK = JobConfig(n_estimators=12, max_depth=6, boosting_iters=8, model_type="rf")
KEY = ("url_id",)

# Extra rules next to the default ones: a disabled one, a broken one, one per further kind.
EXTRA_RULES = (
    ("switched_off", "example", "low", 0.1, "contains", False),
    ("broken", "(unclosed", "low", 0.1, "regex", True),
    ("has_login", "LOGIN", "low", 0.2, "contains", True),
    ("tk_zone", "tk", "low", 0.2, "tld", True),
    ("ends_html", ".HTML", "low", 0.2, "suffix", True),
    ("own_kind", "http", "low", 0.2, "no_such_kind", True),
    ("told_only", "verify", "info", 0.7, "contains", True),
)
# A small forest: (tree, node, left, right, feature, threshold, class-1 share, weight). Weights and
# thresholds are such that no two features gain the same amount.
SMALL_FOREST_FEATURES = ("url_length", "dots", "suspicious_tld", "has_ip")
SMALL_FOREST = (
    (0, 0, 1, 4, "url_length", 40.5, 0.5, 100.0), (0, 1, 2, 3, "dots", 1.5, 0.3125, 64.0), (0, 2, -1, -1, None, None, 0.125, 40.0),
    (0, 3, -1, -1, None, None, 0.625, 24.0), (0, 4, 5, 6, "suspicious_tld", 0.5, 0.84375, 36.0), (0, 5, -1, -1, None, None, 0.75, 20.0),
    (0, 6, -1, -1, None, None, 0.96875, 16.0),
    (1, 0, 1, 2, "suspicious_tld", 0.5, 0.46875, 90.0), (1, 1, -1, -1, None, None, 0.375, 70.0), (1, 2, 3, 4, "url_length", 30.5, 0.8125, 20.0),
    (1, 3, -1, -1, None, None, 0.71875, 11.0), (1, 4, -1, -1, None, None, 0.9375, 9.0),
    (2, 0, 1, 6, "has_ip", 0.5, 0.53125, 110.0), (2, 1, 2, 5, "dots", 2.5, 0.4375, 95.0), (2, 2, 3, 4, "dots", 1.5, 0.34375, 60.0),
    (2, 3, -1, -1, None, None, 0.28125, 33.0), (2, 4, -1, -1, None, None, 0.40625, 27.0), (2, 5, -1, -1, None, None, 0.59375, 35.0),
    (2, 6, -1, -1, None, None, 0.90625, 15.0),
)
WATCH_ENTRIES = ("evil", "weebly", "  ")

_made: dict[tuple, object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, make):
    """Tables and models that several queries share are made once per session."""
    at = (spark.sparkContext.applicationId, sf_dir, name)
    if at not in _made:
        _made[at] = make()
    return _made[at]


def scored_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, label, score): quality labels against a score with many ties."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("quality").alias("label"),
        ((F.col("n_chars") % 1000) / 1000.0).alias("score"),
    )


def linear_score() -> Column:
    """A fixed logistic of six features, rounded to six places; 0 for unreadable rows."""
    z = F.lit(SIMILARITY_FREE_SCORE["intercept"])
    for name, weight in SIMILARITY_FREE_SCORE.items():
        if name != "intercept":
            z = z + F.lit(weight) * F.col(name)
    return F.when(F.col("error").isNull(), F.round(1.0 / (1.0 + F.exp(-z)), 6)).otherwise(0.0)


def scored_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, url, label, score) over the URL corpus."""
    parsed = with_url_features(url_corpus(spark, sf_dir), similarity=False, flags=False)
    return parsed.select(F.col("url_id").alias("id"), "url", "label", linear_score().alias("score"))


def timed(df: DataFrame, spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Every row with the time of an event: number ``key`` modulo the number of events.

    Both sides are sorted and merged: files tell little of the size of their rows, and a
    side that is sent whole by that size must fit into the driver.
    """
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("_event"), "ts").hint("merge")
    return df.withColumn("_event", F.pmod(F.col(key), F.lit(events.count()))).join(events, "_event").drop("_event")


def small_forest_nodes(spark: SparkSession) -> DataFrame:
    rows = [
        (t, n, left, right, SMALL_FOREST_FEATURES.index(f) if f else -1, share, weight)
        for t, n, left, right, f, _, share, weight in SMALL_FOREST
    ]
    return spark.createDataFrame(rows, NODE_SCHEMA)


def small_forest_leaves() -> Column:
    """The leaf of each tree of the small forest, from the feature columns."""
    nodes = {(t, n): (left, right, f, cut) for t, n, left, right, f, cut, _, _ in SMALL_FOREST}
    numbers = {}
    for t, n in sorted(k for k, v in nodes.items() if v[0] < 0):
        numbers[t, n] = float(sum(at[0] == t for at in numbers))

    def leaf(t: int, n: int) -> Column:
        left, right, f, cut = nodes[t, n]
        return F.lit(numbers[t, n]) if left < 0 else F.when(F.col(f) <= cut, leaf(t, left)).otherwise(leaf(t, right))

    return F.array(*[leaf(t, 0) for t in sorted({t for t, _ in nodes})])


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction log of all scored URLs, at the times of events."""
    score = F.col("score")
    return timed(scored_urls(spark, sf_dir), spark, sf_dir, "id").select(
        F.col("id").cast("string").alias("id"),
        "ts",
        "url",
        score.alias("prob"),
        F.when(score >= 0.5, 1).otherwise(0).alias("prediction"),
        F.bround(score * 100, 0).cast("int").alias("risk"),
        F.lit(0.5).alias("threshold"),
        F.lit("fixed").alias("model_hash"),
        F.lit("batch").alias("source"),
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, true_label, source, ts): all corpus labels, at the times of events."""
    return timed(url_corpus(spark, sf_dir), spark, sf_dir, "url_id").select(
        "url", F.col("label").alias("true_label"), F.lit("user").alias("source"), "ts"
    )


def rules(spark: SparkSession) -> DataFrame:
    return default_rules(spark).unionByName(spark.createDataFrame(list(EXTRA_RULES), RULES_SCHEMA))


def watchlist(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(e,) for e in WATCH_ENTRIES], "entry string")


def many_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A watchlist that grows with the pages: their hosts in capitals, and a word with each page's number."""
    pages = table(spark, sf_dir, "pages")
    host = F.upper(F.regexp_extract("url", "://([^/]+)", 1))
    number = F.concat(F.lit(" Invoice"), F.col("page_id").cast("string"))
    return pages.select(F.explode(F.array(host, number)).alias("entry"))


def many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules, and rules of each simple kind for the numbers, hosts and zones of the pages."""
    pages = table(spark, sf_dir, "pages")
    number = F.col("page_id").cast("string")
    host = F.lower(F.regexp_extract("url", "://([^/]+)", 1))
    patterns = {
        "contains": F.concat(F.lit("CASE="), number), "prefix": F.concat(F.lit("HTTPS://tinyurl.com/"), number),
        "suffix": F.concat(F.lit("&F="), number), "host_equals": host, "tld": F.element_at(F.split(host, "[.]"), -1),
    }
    each = F.array(*[F.struct(F.lit(kind).alias("kind"), p.alias("pattern")) for kind, p in patterns.items()])
    own = pages.select(F.inline(each)).distinct().select(
        F.concat("kind", F.lit("-"), "pattern").alias("name"), "pattern", F.lit("low").alias("severity"), F.lit(0.1).alias("weight"), "kind",
        F.lit(True).alias("enabled"),
    )
    return rules(spark).unionByName(own)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registry entry per event: the version is the event type, so versions repeat."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_type").alias("version"),
        F.concat(F.lit("models/"), F.col("event_id").cast("string")).alias("path"),
        F.lit("cfg").alias("cfg_hash"),
        F.create_map(F.lit("value"), F.col("value")).alias("metrics"),
        F.lit("").alias("notes"),
        "ts",
    ).to(spark.createDataFrame([], REGISTRY_SCHEMA).schema)


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled corpus rows with features, reason sums and hashed n-grams, written once."""

    def make() -> DataFrame:
        return written(M.gram_stage(QUICK.ngram_dim).transform(labelled_features(url_corpus(spark, sf_dir))), "features")

    return once(spark, sf_dir, "features", make)


def forest(spark: SparkSession, sf_dir: str) -> M.Member:
    return once(spark, sf_dir, "forest", lambda: M.fit_model(feature_table(spark, sf_dir), "rf", QUICK, KEY))


