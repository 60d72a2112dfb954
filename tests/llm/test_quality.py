import zlib

import numpy as np

from linksift.llm.quality import FEATURES, feature_matrix, features, fit_tables, good_documents, quality_scores


def test_features_are_finite():
    x = feature_matrix([None, "", " \n", "a", "The cat. " * 9, "🙂" * 50, "|" * 99, "x " * 5000])
    assert x.shape == (8, len(FEATURES)) and np.isfinite(x).all()
    assert features(None) == features(" \n") == [0.0] * len(FEATURES)


def test_single_features_and_a_pair_are_learnt():
    rng = np.random.default_rng(7)
    x = rng.random((4000, 4))
    for y in (x[:, 0] > 0.3, (x[:, 1] > 0.5) ^ (x[:, 2] > 0.5)):
        model = fit_tables(x[:3000], y[:3000].astype(float))
        assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    assert (1, 2) in model.pairs
    lone = fit_tables(x, np.ones(4000))
    assert 0.99 < lone.score(x).min() <= 1


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_scores(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 0), (7, None, 0), (None, 1, 0), (5, 1, 0), (999, 0, 1)], "doc_id long, quality int, toxic int")
    got = quality_scores(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(r.score is not None for r in got)
    assert quality_scores(odd_docs, labels.limit(0)).count() == odd_docs.count()
    assert quality_scores(no_docs, labels).collect() == []
    assert good_documents(odd_docs, labels).columns == odd_docs.columns


def test_labels_of_held_out_rows_say_nothing(spark, documents, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    score = lambda lab: sorted((r.doc_id, r.score) for r in quality_scores(documents, lab).collect())
    assert score(labels) == score(other)


def test_repeated_ids_count_once_a_label(spark):
    rows = [(i, ("word " * (i % 30 + 1)) if i % 2 else "| 1 2 3 " * (i % 30 + 1)) for i in range(1, 400)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hot = docs.union(spark.createDataFrame([(1, rows[0][1])] * 500, docs.schema))
    more = labels.union(spark.createDataFrame([(1, 1)] * 50 + [(2, 0)] * 50, labels.schema))
    score = lambda d, lab: sorted({(r.doc_id, r.score) for r in quality_scores(d, lab, fit_rows=150).collect()})
    want = score(docs, labels)
    assert score(hot.repartition(7), more.repartition(5)) == score(hot.coalesce(1), more.coalesce(1)) == want
    # two texts of one id: the one with the smaller features counts, whatever the order
    two = docs.union(spark.createDataFrame([(i, t + " other, text") for i, t in rows[:50]], docs.schema))
    assert score(two.repartition(9), labels) == score(two.orderBy("text").coalesce(1), labels)


def test_no_single_task_takes_the_texts(spark, documents, sf, monkeypatch):
    import linksift.llm.quality as quality

    plans = []
    plain = type(documents).toPandas
    monkeypatch.setattr(type(documents), "toPandas", lambda self: (plans.append(self._jdf.queryExecution().executedPlan().toString()), plain(self))[1])
    quality.fit(documents, spark.read.parquet(f"{sf}/labels.parquet"))
    assert len(plans) == 1
    above, _, below = plans[0].partition("MapInPandas")  # the texts come below, features above
    assert below and "SinglePartition" not in above


def test_very_long_texts(spark):
    docs = spark.createDataFrame([(1, "word and more, " * 30_000), (2, "x" * 400_000), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality_scores(docs, labels).collect())
