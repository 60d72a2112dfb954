"""Models, explanations, mutations, online learning and streams."""

import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from linksift.config import JobConfig, fingerprint, read_settings, settings_row
from linksift.constants import FEATURES
from linksift.operators.evaluate import roc_auc
from linksift.operators import models as M
from linksift.operators.explain import explained_score, tree_contributions
from linksift.operators.models import gram_stage, permutation_importance, tested_features
from linksift.operators.mutate import MUTATORS, mutate_urls
from linksift.operators.ngrams import char_ngrams
from linksift.operators.online import empty_state, online_update, state_from_table, state_table, with_online_prob
from linksift.plans import fixtures as T_
from linksift.plans.catalog import QUERIES, linear_scorer
from linksift.plans.train import TrainedModel, load_model, train
from linksift.operators.scoring import scan
from linksift.sources.corpus import url_corpus
from linksift.streaming.watch import learn, learn_batch, watch, watch_alerts


def test_forest_separates_the_corpus(spark, sf):
    scored = T_.forest(spark, sf).score(T_.feature_table(spark, sf)).withColumn("score", F.col("probability"))
    assert roc_auc(scored).first()[0] > 0.9


def test_importance_without_needless_copies(spark, sf):
    """Features that no tree tests lose nothing, and grams hashed once change no figure."""
    member = T_.forest(spark, sf)
    rows = T_.feature_table(spark, sf).limit(60)
    tested = tested_features(member)
    some = (*sorted(tested)[:3], *[c for c in FEATURES if c not in tested][:2])
    assert 0 < len(tested) < len(FEATURES)
    whole = permutation_importance(rows, member.score, 2, key="url_id", columns=some).collect()
    short = permutation_importance(rows, member.score, 2, key="url_id", columns=some, tested=tested, grams=gram_stage(T_.QUICK.ngram_dim)).collect()
    assert [tuple(r) for r in short] == [tuple(r) for r in whole] and len(short) == 5


def test_contributions_explain_the_forest(spark, sf):
    """Without the weighting of steps, path sums end at the leaf; with it they keep sign and bound."""
    member = T_.forest(spark, sf)
    rows = tree_contributions(T_.feature_table(spark, sf).limit(200), member).collect()
    assert len({r.base_value for r in rows}) == 1 and 0 < rows[0].base_value < 1
    assert all(r.contributions and all(v != 0 for v in r.contributions.values()) for r in rows)
    assert all(abs(sum(r.contributions.values())) <= 1 for r in rows)


def saved_trees(spark, clf, folder):
    clf.write().overwrite().save(folder)
    trees = {}
    for r in spark.read.parquet(f"{folder}/data").collect():
        trees.setdefault(r.treeID, {})[r.nodeData.id] = r.nodeData
    return list(trees.values())


def plain_contributions(trees, vector):
    """One tree after the other, one node after the other."""
    share = lambda n: n.impurityStats[1] / sum(n.impurityStats)
    gained, base = {}, 0.0
    for nodes in trees:
        at = nodes[0]
        base += share(at)
        while at.leftChild >= 0:
            value, cut = vector[at.split.featureIndex], at.split.leftCategoriesOrThreshold
            goes_left = value <= cut[0] if at.split.numCategories < 0 else value in cut
            to = nodes[at.leftChild if goes_left else at.rightChild]
            change = (share(to) - share(at)) * (0.5 + 0.5 * sum(to.impurityStats) / sum(at.impurityStats))
            gained[at.split.featureIndex] = gained.get(at.split.featureIndex, 0.0) + change
            at = to
    return gained, base


@pytest.fixture(scope="module")
def folded(spark, sf):
    """A calibrated model: in each of two folds a vote of three kinds."""
    cfg = replace(T_.QUICK, n_estimators=4, max_depth=4, boosting_iters=1, ngram_dim=4)
    return M.calibrate(T_.feature_table(spark, sf), lambda df: M.fit_voting(df, cfg), folds=2, key=T_.KEY), cfg


def test_contributions_of_calibrated_votes(spark, sf, folded, tmp_path):
    """All forests of all folds count, and a join by key gives what the map-only way gives."""
    model, cfg = folded
    rows = T_.feature_table(spark, sf).filter("url_id % 19 = 0")
    scored = {r.url_id: r for r in explained_score(model)(rows).collect()}
    assert len(scored) == rows.count() > 40
    plain = {r.url_id: r.probability for r in model.score(rows).collect()}
    assert all(abs(r.probability - plain[i]) < 1e-12 for i, r in scored.items())
    forests = [m for pair, _ in model.pairs for m in pair.members[:2]]
    vectors = [{r.url_id: r.features.toArray() for r in m.prep.transform(M.prepared(rows)).select("url_id", "features").collect()} for m in forests]
    names = M.vector_names(cfg)
    saved = [saved_trees(spark, m.clf, str(tmp_path / f"f{i}")) for i, m in enumerate(forests)]
    trees = sum(map(len, saved))
    for url_id in scored:
        total, base = {}, 0.0
        for one, vector in zip(saved, vectors):
            gained, b = plain_contributions(one, vector[url_id])
            base += b
            for f, v in gained.items():
                total[names[f]] = total.get(names[f], 0.0) + v
        got = scored[url_id]
        assert trees == 16 and abs(got.base_value - base / trees) < 1e-12
        assert all(abs(got.contributions.get(f, 0.0) - v / trees) < 1e-12 for f, v in total.items())
        assert got.contributions.keys() <= total.keys()
    for r in explained_score(model, most_steps=0)(rows).collect():
        same = scored[r.url_id].contributions
        assert all(abs(r.contributions.get(f, 0.0) - same.get(f, 0.0)) < 1e-12 for f in {*r.contributions, *same})


def test_contributions_of_other_models(spark, sf, folded):
    """Boosted trees alone are explained in margins; a linear model and error rows have none."""
    _, cfg = folded
    table = T_.feature_table(spark, sf)
    boosted = M.fit_model(table, "hgb", cfg)
    row = explained_score(boosted)(table.limit(5)).first()
    assert row.contributions and row.base_value != 0
    linear = explained_score(M.fit_model(table, "sgd", cfg))(table.limit(5))
    assert "contributions" not in linear.columns
    urls = spark.createDataFrame([("http://a.ga/x",), ("  ",)], "url string")
    out = {r.url: r for r in scan(urls, TrainedModel(T_.forest(spark, sf), 0.5, None, 0, None, "h").scorer()).collect()}
    assert out["http://a.ga/x"].contributions and out["http://a.ga/x"].base_value > 0
    assert out["  "].contributions == {} and out["  "].base_value == 0


def test_training_run_and_round_trip(spark, sf, tmp_path):
    cfg = JobConfig(
        n_estimators=5, max_depth=4, boosting_iters=3, bootstrap_iters=20, cv_folds=2, ngram_dim=16,
        permutation_repeats=1, adversarial_mutations=6, model_type="rf",
    )
    trained, tables = train(url_corpus(spark, sf), cfg, ("url_id",))
    assert tables["metrics"].first().roc_auc > 0.85
    assert {r.criterion for r in tables["thresholds"].collect()} == {"f1", "cost", "youden", "balanced", "mcc", "chosen"}
    trained.save(spark, str(tmp_path / "m"))
    back = load_model(spark, str(tmp_path / "m"))
    columns = ["url_id", "probability", "risk", "verdict", "abstain"]
    a, b = (scan(url_corpus(spark, sf), m.scorer()).select(columns) for m in (trained, back))
    assert a.exceptAll(b).isEmpty()
    TrainedModel(back.model, 0.5, None, 0, None, "x", schema_version=2).save(spark, str(tmp_path / "old"))
    with pytest.raises(ValueError, match="schema version 2"):
        load_model(spark, str(tmp_path / "old"))


def test_ngrams(spark):
    got = spark.range(1).select(char_ngrams(F.lit("aB c"))).first()[0]
    assert got == [" a", "ab", "b ", " ab", "ab ", " ab ", " c", "c ", " c "]


def test_mutations_do_not_depend_on_partitioning(spark, sf):
    df = url_corpus(spark, sf).select("url_id", "url")
    a = mutate_urls(df, 2)
    assert a.count() == df.count() * 2 * len(MUTATORS)
    assert a.exceptAll(mutate_urls(df.repartition(5), 2)).isEmpty()
    one = {r.mutator: r.url for r in mutate_urls(spark.createDataFrame([("http://paypal.com/a",)], "url string"), 1).collect()}
    assert one["path_noise"].startswith("http://paypal.com/a/") and one["case"].lower() == "http://paypal.com/a"
    assert one["subdomain"].endswith("-paypal.com/a") and "%" in one["percent"] and ".com" not in one["tld"]


def test_online_step_by_hand(spark):
    df = spark.createDataFrame([(1.0, 1), (3.0, 0)], "x double, label int")
    s = online_update(empty_state(("x",)), df, rate=0.5, batch_id=0)
    assert (s.n, s.mean, s.scale()) == (2, (2.0,), [1.0])
    # scaled -1 and 1, misses -0.5 and 0.5: mean pull 0.5
    assert s.coef[0] == pytest.approx(-0.25 + 0.5 * 1e-4 * 0.15)
    assert online_update(s, df, batch_id=0) is s
    assert state_from_table(state_table(spark, s), ("x",)) == s
    p = with_online_prob(df, s).orderBy("x").first().online_prob
    assert p == pytest.approx(1 / (1 + math.exp(-(s.coef[0] * -1 + s.intercept))))
    assert with_online_prob(df, empty_state(("x",))).first().online_prob is None


def test_watch_equals_batch_and_drops_copies(spark, tmp_path):
    for name, text in (("a.txt", "http://a.tk/\n \nhttp://b.com/ \n"), ("b.txt", "http://a.tk/\nhttp://user@c.com/\n")):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text(text)
    q = watch(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark"), linear_scorer(), trigger={"availableNow": True})
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("url", "risk", "verdict", "probability")
    urls = spark.createDataFrame([("http://a.tk/",), ("http://b.com/",), ("http://user@c.com/",)], "url string")
    want = scan(urls, linear_scorer(), source="watch").select("url", "risk", "verdict", "probability")
    assert got.exceptAll(want).isEmpty() and got.count() == 3
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "out")).schema).parquet(str(tmp_path / "out"))
    watch_alerts(stream.withColumn("risk", F.lit(90)), str(tmp_path / "alerts"), str(tmp_path / "mark2"), {"availableNow": True}).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == 3


def test_feedback_stream_counts_each_batch_once(spark, tmp_path):
    rows = [("http://a.tk/x", 1, "user"), ("https://b.com/", 0, "user"), (" ", 1, "user")]
    spark.createDataFrame(rows, "url string, true_label int, source string").write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("url string, true_label int, source string").json(str(tmp_path / "in"))
    states = []
    learn(
        spark, stream, str(tmp_path / "state"), empty_state(), str(tmp_path / "mark"), str(tmp_path / "log"),
        states.append, {"availableNow": True},
    ).awaitTermination()
    assert states[-1].n == 2 and spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_settings(spark):
    cfg = read_settings(spark, '{"cv_folds": 3, "no_such": 1, "decision_threshold": 0.4, "use_calibration": false, "model_type": "rf"}')
    assert cfg == JobConfig(cv_folds=3, decision_threshold=0.4, use_calibration=False, model_type="rf")
    assert read_settings(spark, settings_row(spark, cfg).toJSON().first()) == cfg
    assert read_settings(spark, "{}") == read_settings(spark, "no object") == JobConfig()
    assert len(fingerprint(cfg)) == 16 and fingerprint(cfg) != fingerprint(JobConfig()) == fingerprint(JobConfig())


def test_a_batch_that_runs_again_is_logged_once(spark, tmp_path):
    batch = spark.createDataFrame([("http://a.tk/x", 1, "user")], "url string, true_label int, source string")
    first = learn_batch(spark, batch, 4, empty_state(), str(tmp_path / "log"))
    again = learn_batch(spark, batch, 4, empty_state(), str(tmp_path / "log"))
    assert first == again and spark.read.parquet(str(tmp_path / "log")).count() == 1


def test_feedback_counts_under_a_new_checkpoint(spark, tmp_path):
    spark.createDataFrame([("http://a.tk/x", 1, "user")], "url string, true_label int, source string").write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("url string, true_label int, source string").json(str(tmp_path / "in"))
    states = []
    old = replace(empty_state(), last_batch=57)
    learn(
        spark, stream, str(tmp_path / "state"), old, str(tmp_path / "mark"), str(tmp_path / "log"), states.append, {"availableNow": True},
        rate=0.25, class_weight=(1.0, 3.0),
    ).awaitTermination()
    assert states[-1].n == 1 and states[-1].last_batch == 0
    assert states[-1].intercept == pytest.approx(0.25 * 0.5 * 3)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 1


@pytest.mark.parametrize("name", ["scan_batch", "calibrate", "perm_importance", "adversarial_probe", "model_roundtrip"])
def test_queries_without_sql_give_rows(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert df.count() > 0
    if name == "model_roundtrip":
        assert df.filter("before <> after").isEmpty()
