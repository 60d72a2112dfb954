"""Evaluation, order statistics, splits, drift and bootstrap against brute force."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linksift.operators import evaluate as E
from linksift.operators.bootstrap import bootstrap_ci
from linksift.operators.drift import psi
from linksift.operators.ranked import cumulative_counts, exact_quantiles
from linksift.operators.splits import stratified_folds, stratified_split


def skewed(n=3000, seed=1):
    """Scores of which a third are one value."""
    rng = np.random.default_rng(seed)
    score = np.where(rng.random(n) < 0.33, 0.5, rng.random(n).round(3))
    label = (rng.random(n) < 0.2 + 0.6 * score).astype(int)
    return label, score


def frame(spark, label, score):
    rows = [(i, int(l), float(s)) for i, (l, s) in enumerate(zip(label, score))]
    return spark.createDataFrame(rows, "id long, label int, score double")


def test_quantiles_equal_numpy(spark):
    _, score = skewed()
    probs = [0.0, 0.01, 0.1, 1 / 3, 0.5, 0.77, 0.99, 1.0]
    df = frame(spark, np.zeros(len(score)), score).withColumn("twice", F.col("score") * 2)
    got = {(r.feature, r.prob): r.value for r in exact_quantiles(df, ["score", "twice"], probs).collect()}
    for p in probs:
        assert got["score", p] == pytest.approx(np.quantile(score, p), abs=1e-12)
        assert got["twice", p] == pytest.approx(np.quantile(score * 2, p), abs=1e-12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40))
def test_quantiles_of_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    got = {r.prob: r.value for r in exact_quantiles(df, ["x"], [0.0, 0.3, 1.0]).collect()}
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-9)


def test_running_counts(spark):
    label, score = skewed()
    rows = cumulative_counts(frame(spark, label, score)).collect()
    assert len(rows) == len(set(score))
    for r in rows:
        assert r.tp == ((score >= r.score) & (label == 1)).sum()
        assert r.fp == ((score >= r.score) & (label == 0)).sum()
    assert sum(r.first for r in rows) == 1


def brute_auc(label, score):
    pos, neg = score[label == 1], score[label == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def test_metrics(spark):
    label, score = skewed()
    df = frame(spark, label, score)
    m = E.binary_metrics(df, 0.5).first()
    assert m.roc_auc == pytest.approx(brute_auc(label, score), abs=1e-12)
    assert (m.tn, m.fp, m.fn, m.tp) == tuple(E.confusion(df, 0.5).first())
    assert m.brier == pytest.approx(((score - label) ** 2).mean())
    curve = E.roc_curve(df).orderBy("fpr", "tpr").collect()
    full = E.roc_curve(df, drop_intermediate=False).orderBy("fpr", "tpr").collect()
    area = lambda c: sum((b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(c, c[1:]))
    assert len(curve) <= len(full) and area(curve) == pytest.approx(m.roc_auc) == pytest.approx(area(full))


def test_threshold_scan(spark):
    label, score = skewed(400)
    rows = E.scan_thresholds(frame(spark, label, score)).orderBy("threshold").collect()
    grid = np.unique(np.concatenate([np.linspace(0.02, 0.98, 49), np.quantile(score, np.linspace(0.01, 0.99, 33))]))
    assert [r.threshold for r in rows] == pytest.approx(list(grid), abs=1e-12)
    recalls = [r.recall for r in rows]
    assert recalls == sorted(recalls, reverse=True)
    for r in rows:
        hit = score >= r.threshold
        assert (r.fp, r.fn) == ((hit & (label == 0)).sum(), (~hit & (label == 1)).sum())
        assert r.expected_cost == 10 * r.fn + r.fp
    chosen = {r.criterion: r.threshold for r in E.select_thresholds(E.scan_thresholds(frame(spark, label, score))).collect()}
    cheapest = min(r.expected_cost for r in rows)
    assert chosen["cost"] == min(r.threshold for r in rows if r.expected_cost == cheapest)


def test_conformal(spark):
    label, score = skewed()
    df = frame(spark, label, score)
    q, n = E.conformal_fit(df, 0.1).first()
    strange = np.sort(np.where(label == 1, 1 - score, score))
    assert n == len(score) and q == pytest.approx(strange[int(np.ceil((n + 1) * 0.9)) - 1])
    assert E.conformal_coverage(df, q).first().coverage >= 0.9 - 1e-9
    rows = E.conformal_sets(df, 0.3).collect()
    assert all(r.abstain == (r.in0 and r.in1) for r in rows) and any(not r.in0 and not r.in1 for r in rows)
    assert tuple(E.conformal_fit(df.limit(0)).first()) == (1.0, 0)


def test_bootstrap(spark):
    label, score = skewed(1500)
    df = frame(spark, label, score)
    own = {"share_flagged": lambda tn, fp, fn, tp: (fp + tp) / (tn + fp + fn + tp)}
    a = {r.metric: (r.lo, r.hi) for r in bootstrap_ci(df, 0.5, 200, extra=own).collect()}
    point = E.binary_metrics(df, 0.5).first().asDict() | {"share_flagged": (score >= 0.5).mean()}
    assert len(a) == 9 and all(lo <= point[m] <= hi for m, (lo, hi) in a.items())
    assert a["roc_auc"][1] - a["roc_auc"][0] < 0.12
    b = {r.metric: (r.lo, r.hi) for r in bootstrap_ci(df.repartition(7), 0.5, 200, extra=own).collect()}
    assert all(b[m] == pytest.approx(a[m], abs=1e-9) for m in a)
    assert all(r.lo is None for r in bootstrap_ci(df, 0.5, 0).collect())


def brute_psi(ref, cur, bins=10):
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, bins + 1)))
    if len(ref) < 10 or len(cur) < 10 or len(edges) < 3:
        return 0.0
    edges[0] -= 1e-9
    edges[-1] += 1e-9
    r, c = (np.histogram(x, edges)[0] for x in (ref, cur))
    r, c = (np.clip(x / max(x.sum(), 1), 1e-6, None) for x in (r, c))
    return float(((c - r) * np.log(c / r)).sum())


def test_psi(spark):
    rng = np.random.default_rng(3)
    ref, cur = rng.integers(0, 20, 500).astype(float), rng.integers(3, 30, 300).astype(float)
    few, flat = rng.random(500), np.ones(500)
    a = spark.createDataFrame([tuple(map(float, t)) for t in zip(ref, few, flat)], "x double, y double, z double")
    b = spark.createDataFrame([(float(v), float(v) / 30 if i < 5 else None, 1.0) for i, v in enumerate(cur)], "x double, y double, z double")
    got = {r.feature: r.psi for r in psi(a, b, ["x", "y", "z"]).collect()}
    assert got["x"] == pytest.approx(brute_psi(ref, cur), abs=1e-9)
    assert got["y"] == 0.0 and got["z"] == 0.0
    assert all(r.psi == pytest.approx(0.0, abs=1e-12) for r in psi(a, a, ["x", "y", "z"]).collect())


def test_splits(spark):
    label, score = skewed(1000)
    df = frame(spark, label, score)
    n = {k: (label == k).sum() for k in (0, 1)}
    for r in stratified_split(df, ["id"]).filter("part = 'test'").groupBy("label").count().collect():
        assert abs(r["count"] - 0.2 * n[r.label]) <= 1
    for r in stratified_folds(df, ["id"], 5).groupBy("label", "fold").count().collect():
        assert abs(r["count"] - n[r.label] / 5) <= 1
    again = stratified_folds(df.repartition(9), ["id"], 5).select("id", "fold")
    assert again.exceptAll(stratified_folds(df, ["id"], 5).select("id", "fold")).isEmpty()
