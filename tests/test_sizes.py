"""Work that must grow no faster than its input, and tasks that must stay small."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from linksift.operators import models as M
from linksift.operators import mutate as X
from linksift.plans import catalog as C
from linksift.plans import fixtures as T_
from linksift.sources.corpus import PAGES_A_TASK, url_corpus


def test_percent_of_long_urls(spark):
    """Looking up each character by its place split the URL once for every character."""
    url = F.concat(F.lit("http://a.example/"), F.repeat(F.lit("abcdefghij"), 2_000))
    began = time.monotonic()
    changed = X.mutate_urls(spark.range(50).select(url.alias("url")), 1, mutators={"percent": X.percent})
    # one character became three
    assert changed.filter(F.length("url") == F.length("base_url") + 2).count() == 50
    assert time.monotonic() - began < 30


def test_case_and_homoglyph_follow_the_draws(spark):
    """The comparison of hex digits is that of the drawn numbers."""
    rows = spark.range(300).select(F.concat(F.lit("key"), F.col("id")).alias("k"), F.col("id").alias("i"))
    for chance in (X.LOOKALIKE_CHANCE, X.UPPER_CHANCE):
        by_number = X.draw(F.col("k"), F.col("i")) < int(X.DRAW_RANGE * chance)
        assert rows.filter(by_number != X._below(F.col("k"), F.col("i"), chance)).count() == 0


def test_pages_are_dealt_by_their_number(spark, tmp_path):
    """One small file of many pages: a task makes the URLs of a bounded number of them."""
    n = 40 * PAGES_A_TASK
    pages = spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit("http://a.example/"), "id").alias("url"))
    pages.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    sizes = url_corpus(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 21 * n
    assert max(r["count"] for r in sizes) <= 2 * 21 * PAGES_A_TASK


class Counting:
    """A model that counts the rows it scores."""

    def __init__(self, spark):
        self.rows = rows = spark.sparkContext.accumulator(0)

        def seen(x: int) -> float:
            rows.add(1)
            return (x * 37 % 101) / 101

        self.column = F.udf(seen, "double")

    def score(self, df):
        return df.withColumn("probability", self.column("url_id"))


def _labelled(spark, n: int):
    return spark.range(n).select(F.col("id").alias("url_id"), (F.col("id") % 3 % 2).cast("int").alias("label"))


def test_held_out_rows_are_scored_once(spark):
    rows, model = _labelled(spark, 600), Counting(spark)
    assert M.cross_validate(rows, lambda df: model, 2, key=("url_id",)).count() == len(M.CV_SCORES)
    assert model.rows.value == 600
    model = Counting(spark)
    M.calibrate(rows, lambda df: model, "isotonic", 2, ("url_id",))
    assert model.rows.value == 600
    model = Counting(spark)
    C.measured(model, rows).collect()
    assert model.rows.value == 600


def test_both_appends_read_one_scan(spark, monkeypatch):
    model = Counting(spark)
    scan = lambda *_: model.score(_labelled(spark, 300)).select(
        F.lit("u").alias("url"), "probability", F.when(F.col("probability") >= 0.5, 1).otherwise(0).alias("verdict"), F.lit(1).alias("risk"),
        F.lit(None).cast("string").alias("error"), F.lit("m").alias("model_hash"), F.lit("batch").alias("source"),
    )
    monkeypatch.setattr(C, "linear_scan", scan)
    assert sum(r.n for r in C.q_audit_append(spark, "").collect()) == 600
    # verdict and probability may each call the function
    assert model.rows.value <= 2 * 300


def test_point_metrics_read_scores_once(spark, monkeypatch):
    model = Counting(spark)
    scored = model.score(_labelled(spark, 300)).withColumnRenamed("probability", "score")
    monkeypatch.setattr(C, "both_scored", lambda *_: {"urls": scored, "docs": scored})
    assert C.q_point_metrics(spark, "").count() == 2
    assert model.rows.value == 600


def test_vectors_are_dealt_by_rows(spark, sf, monkeypatch):
    """One file split of many rows: a task holds the vectors of a bounded number of them."""
    found = []

    class Seen:
        def fit(self, rows):
            found.append(rows.rdd.glom().map(len).collect())

    monkeypatch.setattr(M, "ROWS_A_TASK", 100)
    monkeypatch.setattr(M, "_classifier", lambda kind, cfg: Seen())
    rows = T_.feature_table(spark, sf).coalesce(1)
    M.fit_members(rows, ("rf",), T_.QUICK)
    assert sum(found[0]) == rows.count() and max(found[0]) <= 150


def test_ngrams_are_hashed_once(spark, sf):
    """The shared feature table holds them; a vector of another size is not taken for them."""
    table = T_.feature_table(spark, sf)
    assert "_ngrams" in table.columns
    rehashed = M.gram_stage(16).transform(table.limit(3))
    assert {r["_ngrams"].size for r in rehashed.collect()} == {16}
    assert M.gram_stage(T_.QUICK.ngram_dim).transform(table) is table


def test_events_are_not_sent_whole(spark, tmp_path):
    """The events of a small file are many rows: the driver must not build a table of them."""
    ids = F.col("id")
    spark.range(200_000).select(ids.alias("event_id"), F.lit(0).cast("timestamp").alias("ts")).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    spark.range(3).select(ids.alias("page_id"), F.lit("http://a.example/").alias("url")).write.parquet(str(tmp_path / "pages.parquet"))
    found = T_.feedback(spark, str(tmp_path))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 63
