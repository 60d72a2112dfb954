"""The model queries that are fitted with the published sizes."""

import pytest

from linksift.config import JobConfig
from linksift.operators import models as M
from linksift.plans import catalog as C


class Stop(Exception):
    pass


def settings_of(monkeypatch, spark, sf, name):
    """The kind and settings with which a query asks for its model."""

    def asked(train, kind, cfg, key):
        raise Stop(kind, cfg)

    monkeypatch.setattr(C, "fit_model", asked)
    with pytest.raises(Stop) as stopped:
        C.QUERIES[name](spark, sf)
    return stopped.value.args


def test_boosting_takes_the_published_rounds(spark, sf, monkeypatch):
    kind, cfg = settings_of(monkeypatch, spark, sf, "train_gbt")
    fitter = M._classifier(kind, cfg)
    assert (kind, cfg) == ("hgb", JobConfig())
    assert fitter.getMaxIter() == 400 and fitter.getValidationTol() == 1e-7


def test_forest_takes_the_published_trees(spark, sf, monkeypatch):
    kind, cfg = settings_of(monkeypatch, spark, sf, "train_rf")
    fitter = M._classifier(kind, cfg)
    assert (kind, cfg) == ("rf", JobConfig())
    assert fitter.getNumTrees() == 300 and fitter.getMaxDepth() == 16
