"""Forests as flat arrays give what the library's forests give."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from linksift.operators import models as M
from linksift.operators.models import gram_stage, permutation_importance, tested_features
from linksift.plans import fixtures as T_
from linksift.plans import train as train_module
from linksift.sources.corpus import url_corpus

GRAMS = gram_stage(T_.QUICK.ngram_dim)


def figures(df):
    return {r.feature: (r["mean"], r["std"]) for r in df.collect()}


def noisy(rows):
    """Some of the rows, with labels that no score tells apart: any change of a score then shows."""
    return rows.filter("url_id % 7 = 0").withColumn("label", F.when(F.col("url_id") % 5 == 0, 1 - F.col("label")).otherwise(F.col("label")))


def test_importance_of_a_forest_by_flat_arrays(spark, sf):
    """No copy of a row is scored by the library, and no figure changes."""
    member, rows = T_.forest(spark, sf), T_.feature_table(spark, sf)
    rows = noisy(rows)
    weights = dict(zip(M.vector_names(T_.QUICK), member.clf.featureImportances.toArray()))
    some = tuple(sorted(tested_features(member), key=weights.get)[-4:])
    wanted = figures(permutation_importance(rows, member.score, 3, key="url_id", columns=some, grams=GRAMS))
    given = figures(permutation_importance(rows, None, 3, key="url_id", columns=some, grams=GRAMS, model=member))
    assert given == wanted and any(m != 0 for m, _ in given.values())


def test_importance_of_calibrated_folds_by_flat_arrays(spark, sf):
    cfg = replace(T_.QUICK, n_estimators=3, max_depth=4)
    rows = T_.feature_table(spark, sf)
    model = M.calibrate(rows, lambda df: M.fit_model(df, "rf", cfg), folds=2, key=T_.KEY)
    rows = noisy(rows)
    some = tuple(sorted(tested_features(model))[:3])
    wanted = figures(permutation_importance(rows, model.score, 2, key="url_id", columns=some, grams=GRAMS))
    given = figures(permutation_importance(rows, None, 2, key="url_id", columns=some, grams=GRAMS, model=model))
    assert given.keys() == wanted.keys()
    for feature, pair in wanted.items():
        assert given[feature] == pytest.approx(pair, abs=1e-9)


def test_training_hands_its_model_to_the_importances(spark, sf, monkeypatch):
    """The report's importances are then walked as flat arrays, and not scored copy by copy."""
    given = {}

    def importance(df, score, *args, **kwargs):
        given.update(kwargs)
        raise InterruptedError

    cfg = replace(T_.QUICK, n_estimators=2, max_depth=2, cv_folds=1, use_calibration=False)
    monkeypatch.setattr(M, "permutation_importance", importance)
    monkeypatch.setattr(train_module, "bootstrap_ci", lambda *args, **kwargs: None)
    with pytest.raises(InterruptedError):
        train_module.train(url_corpus(spark, sf), cfg, T_.KEY)
    assert M.flat_model(given["model"]) is not None
