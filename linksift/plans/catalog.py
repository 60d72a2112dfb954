"""The registered queries: name -> function of (session, folder of tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linksift.config import JobConfig
from linksift.constants import CONTINUOUS_FEATURES, DOUBLE_FEATURES, FEATURES
from linksift.functions.similarity import brand_distance, brand_likeness
from linksift.functions.text import shannon
from linksift.operators import drift as D
from linksift.operators import evaluate as E
from linksift.operators import mutate as X
from linksift.operators import ranking as K
from linksift.operators import reasons as R
from linksift.operators.bootstrap import bootstrap_ci
from linksift.operators.explain import explained_score, path_table, top_contributions, tree_contributions, with_contributions
from linksift.operators.models import (
    calibrate,
    cross_validate,
    fit_model,
    gram_stage,
    permutation_importance,
    tested_features,
)
from linksift.operators.ngrams import char_ngrams
from linksift.operators.online import empty_state, online_update, state_table
from linksift.operators.parse import (
    with_tokens,
    with_url_features,
    with_url_parts,
)
from linksift.operators.registry import latest, register
from linksift.operators.scoring import (
    SCAN_COLUMNS,
    Scorer,
    conformal_label,
    display_label,
    plain_risk,
    scan,
    score_distinct,
)
from linksift.operators.splits import half_split, stratified_folds, stratified_split
from linksift.plans import fixtures as T_
from linksift.plans.fixtures import KEY, QUICK
from linksift.plans.train import TrainedModel, load_model, train, verdicts
from linksift.session import shared_folder, written
from linksift.sinks import writers as S
from linksift.sources.corpus import url_corpus
from linksift.sources.tables import read_rules, spread, table, url_lines
from linksift.streaming.watch import watch

Query = Callable[[SparkSession, str], DataFrame]
EPOCH_RATE = 0.5  # step of the online check, stated so that SQL can repeat it


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def new_folder(spark: SparkSession, name: str) -> str:
    return shared_folder(spark, f"{name}-{uuid.uuid4().hex}")


def linear_scorer() -> Scorer:
    return Scorer(score=lambda df: df.withColumn("probability", T_.linear_score()), threshold=0.5, conformal_q=0.7)


def linear_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan(url_corpus(spark, sf), linear_scorer(), T_.rules(spark))


# --------------------------------------------------------------- sources ----


def q_url_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with blanks, written as text and read back as a line file."""
    pages = table(spark, sf, "pages").select("url")
    padded = F.inline(F.array(*[F.struct(c.alias("value")) for c in (F.concat(F.lit("  "), "url", F.lit("\t ")), F.lit(" "))]))
    folder = new_folder(spark, "lines")
    pages.select(padded).write.text(folder)
    return url_lines(spark, folder)


def q_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links of the pages as URLs: every href joined to the scheme and host of its page."""
    pages = table(spark, sf, "pages")
    front = F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1)
    hrefs = F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)))
    return pages.select("page_id", front.alias("front"), hrefs.alias("href")).select(
        "page_id", F.concat("front", F.when(F.col("href").startswith("/"), "").otherwise("/"), "href").alias("url")
    )


def stored_rules(spark: SparkSession) -> DataFrame:
    """The rules, written as a JSON document and read back."""
    folder = new_folder(spark, "rules")
    S.write_rules(T_.rules(spark), folder)
    return read_rules(spark, folder)


def q_rules_table(spark: SparkSession, sf: str) -> DataFrame:
    """The stored rules, each with its hits in the corpus."""
    stored = stored_rules(spark)
    hits = R.apply_rules(with_url_parts(url_corpus(spark, sf)), stored)
    counts = hits.select(F.explode("rule_reasons.text").alias("text")).groupBy("text").agg(F.count("*").alias("n_hits"))
    named = stored.withColumn("text", F.concat(F.lit("rule: "), "name"))
    return named.join(counts, "text", "left").select(
        "name", "pattern", "severity", "weight", "kind", F.col("enabled").cast("int").alias("enabled"),
        F.coalesce("n_hits", F.lit(0)).cast("long").alias("n_hits"),
    )


# ------------------------------------------------------ parse and features ----


def q_parse_errors(spark, sf):
    return with_url_parts(url_corpus(spark, sf)).groupBy("error").agg(F.count("*").alias("n"))


def q_url_parts(spark, sf):
    return with_url_parts(url_corpus(spark, sf)).select(
        "url_id",
        F.col("u_scheme").alias("scheme"),
        F.col("u_host").alias("host"),
        F.col("u_port").alias("port"),
        F.col("u_path").alias("path"),
        F.col("u_query").alias("query"),
    )


def q_url_features(spark, sf):
    parsed = with_url_features(url_corpus(spark, sf), flags=False)
    return parsed.select("url_id", *[r6(f).alias(f) if f in DOUBLE_FEATURES else F.col(f) for f in FEATURES])


def q_brand_distance(spark, sf):
    parsed = with_url_parts(url_corpus(spark, sf))
    return parsed.select("url_id", F.when(F.col("error").isNull(), brand_distance(F.col("u_labels"))).alias("value"))


def q_brand_jaro_winkler(spark, sf):
    parsed = with_url_parts(url_corpus(spark, sf))
    return parsed.select("url_id", F.when(F.col("error").isNull(), r6(brand_likeness(F.col("u_host")))).alias("value"))


def q_url_flags(spark, sf):
    flags = with_url_features(url_corpus(spark, sf), similarity=False)
    return flags.select(
        "url_id",
        F.array_join("flags.brands", ",").alias("brands"),
        F.array_join("flags.suspicious_words", ",").alias("words"),
        F.col("flags.shortener").cast("int").alias("shortener"),
        F.col("flags.scheme").alias("scheme"),
        F.col("flags.tld").alias("tld"),
        F.col("flags.implicit_scheme").cast("int").alias("implicit_scheme"),
    )


def q_url_tokens(spark, sf):
    parsed = with_tokens(with_url_parts(url_corpus(spark, sf)))
    return parsed.select("url_id", F.posexplode("tokens").alias("pos", "t")).select("url_id", "pos", "t.kind", "t.text", "t.weight")


def q_char_entropy(spark, sf):
    pages = table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("url").alias("s"))
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id").select(
        F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("s")
    )
    return pages.unionByName(docs).select("kind", "id", r6(shannon(F.col("s"))).alias("entropy"))


def q_shortener_semi(spark, sf):
    parsed = with_url_parts(url_corpus(spark, sf))
    return K.from_shorteners(parsed).select("url_id", F.col("u_host").alias("host"))


# ------------------------------------------------------- reasons and scans ----


def q_rule_hits(spark, sf):
    hits = R.apply_rules(with_url_parts(url_corpus(spark, sf)), T_.rules(spark))
    return hits.select(F.explode("rule_reasons.text").alias("name")).groupBy("name").agg(F.count("*").alias("n_hits"))


def _reasoned(spark, sf):
    parsed = with_url_features(url_corpus(spark, sf), keep_parts=True)
    out = R.apply_rules(R.with_heuristics(parsed), T_.rules(spark))
    return out.withColumn("reasons", F.concat("heuristic_reasons", "rule_reasons"))


def q_heuristic_reasons(spark, sf):
    parsed = R.with_heuristics(with_url_features(url_corpus(spark, sf)))
    h = F.col("heuristic_reasons")
    return parsed.select(
        "url_id",
        F.size(h).alias("n_reasons"),
        r6(R.reason_sum(h)).alias("reason_sum"),
        h[0]["text"].alias("top_reason"),
        F.array_join(h["severity"], ",").alias("severities"),
    )


def q_reason_sums(spark, sf):
    return _reasoned(spark, sf).select(
        "url_id",
        F.size("reasons").alias("n_reasons"),
        r6(R.reason_sum(F.col("reasons"))).alias("reason_sum"),
        r6(R.weight_sum(F.col("rule_reasons"))).alias("rule_sum"),
        F.col("reasons")[0]["text"].alias("top_reason"),
    )


def q_risk_score(spark, sf):
    risk = plain_risk(F.lit(0.5), R.reason_sum(F.col("reasons")))
    return _reasoned(spark, sf).select("url_id", F.when(F.col("error").isNull(), risk).otherwise(0).alias("risk"))


def q_watchlist_override(spark, sf):
    out = scan(url_corpus(spark, sf), Scorer(threshold=0.6), T_.rules(spark), T_.watchlist(spark))
    return out.select(
        "url_id", "risk", "verdict", F.col("abstain").cast("int").alias("abstain")
    )


def q_watchlist_joined(spark, sf):
    """A watchlist that grows with the pages, joined with the URLs."""
    out = R.apply_watchlist(url_corpus(spark, sf), T_.many_entries(spark, sf), most_literals=0)
    return out.select("url_id", F.col("watch_hit").cast("int").alias("watch_hit"))


def q_rules_joined(spark, sf):
    """Rules that grow with the pages, joined with the URLs; one row per hit."""
    hits = R.apply_rules(with_url_parts(url_corpus(spark, sf)), T_.many_rules(spark, sf), most_literals=0)
    return hits.select("url_id", F.explode("rule_reasons").alias("r")).select("url_id", "r.text", "r.severity", "r.weight")


def flat_scan(scored: DataFrame) -> DataFrame:
    """A scan without nested columns."""
    nested = {"reasons", "flags", "tokens", "contributions", "conformal_set"}
    flat = [c for c in ("url_id", *SCAN_COLUMNS) if c not in nested]
    return scored.select(
        *flat, F.size("reasons").alias("n_reasons"), F.size("tokens").alias("n_tokens"), F.size("contributions").alias("n_contributions"),
        F.to_json("conformal_set").alias("conformal_set"), F.to_json("flags").alias("flags"),
    )


def forest_scorer(spark, sf) -> Scorer:
    return Scorer(score=explained_score(T_.forest(spark, sf)), threshold=0.5, conformal_q=0.4, model_hash="forest")


def q_scan_batch(spark, sf):
    return flat_scan(scan(url_corpus(spark, sf), forest_scorer(spark, sf), T_.rules(spark), T_.watchlist(spark)))


def q_scan_linear(spark, sf):
    """The whole scan with the fixed linear scorer."""
    out = linear_scan(spark, sf).withColumns(
        {"conformal_0": F.col("conformal_set.clean"), "conformal_1": F.col("conformal_set.phishing")}
    )
    return out.select(
        "url_id", "probability", "verdict", "risk", display_label().alias("label_shown"),
        conformal_label().alias("conformal_shown"), F.size("reasons").alias("n_reasons"), "error",
    )


def q_scan_json(spark, sf):
    folder = new_folder(spark, "json")
    S.write_json(linear_scan(spark, sf), folder)
    back = spark.read.json(folder)
    return back.select("url_id", "url", "probability", "verdict", "risk", F.size("reasons").alias("n_reasons"),
                       F.col("features.url_length").alias("url_length"), F.col("flags.host").alias("host"))


def q_distinct_score(spark, sf):
    thrice = url_corpus(spark, sf).select("url", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("copy"))
    score = lambda df: with_url_features(df, similarity=False, flags=False).select("url", T_.linear_score().alias("score"))
    return score_distinct(thrice, score).groupBy("url").agg(F.count("*").alias("n"), F.max("score").alias("score"))


# ------------------------------------------------------------------ sinks ----


def q_export_csv(spark, sf):
    folder = new_folder(spark, "csv")
    S.write_csv(linear_scan(spark, sf), folder)
    schema = "url string, verdict string, probability string, risk int, abstain int, conformal_0 int, conformal_1 int, reasons string"
    return spark.read.options(**S.CSV_OPTIONS).schema(schema).csv(folder)


def q_stix_indicators(spark, sf):
    folder = new_folder(spark, "stix")
    S.write_stix(linear_scan(spark, sf), folder)
    fields = "name string, pattern string, labels array<string>, confidence int, description string"
    bundle = F.from_json("value", f"type string, id string, spec_version string, objects array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>")
    objects = spark.read.text(folder).select(bundle.alias("b")).filter("b.type = 'bundle' AND b.spec_version = '2.1' AND b.id LIKE 'bundle--%'")
    return objects.select(F.explode("b.objects").alias("o")).select(
        "o.name", "o.pattern", F.array_join("o.labels", ",").alias("labels"), "o.confidence", "o.description"
    )


def q_alerts(spark, sf):
    folder = new_folder(spark, "alerts")
    S.write_alerts(linear_scan(spark, sf), folder)
    return spark.read.parquet(folder).select("url", "probability", "risk", "prediction", F.array_join("reasons", "; ").alias("reasons"))


def q_audit_append(spark, sf):
    folder = new_folder(spark, "log")
    # both appends read one scan
    logged = ("url", "probability", "verdict", "risk", "error", "model_hash", "source")
    scored = written(linear_scan(spark, sf).select(*logged), "scan")
    S.append_predictions(scored, folder, 0.5)
    S.append_predictions(scored, folder, 0.5)
    return spark.read.parquet(folder).groupBy("prediction", "source").agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("n_ids")
    )


def q_feedback_append(spark, sf):
    folder = new_folder(spark, "feedback")
    S.append_feedback(T_.feedback(spark, sf), folder)
    return spark.read.parquet(folder).groupBy("true_label", "source").agg(F.count("*").alias("n"), F.count("prob").alias("n_prob"))


def q_audit_recent(spark, sf):
    return K.recent_predictions(T_.predictions(spark, sf), 100)


def q_recent_urls(spark, sf):
    return K.recent_urls(T_.predictions(spark, sf))


def q_hourly_verdicts(spark, sf):
    return K.hourly_verdicts(T_.predictions(spark, sf))


def q_live_counters(spark, sf):
    return K.live_counters(T_.predictions(spark, sf), 0, 0.5, "fixed")


def q_unseen_urls(spark, sf):
    """URLs that a log of the positive predictions does not hold."""
    return K.unseen_urls(url_corpus(spark, sf), T_.predictions(spark, sf).filter("prediction = 1"))


def q_registry_latest(spark, sf):
    reg = T_.registry(spark, sf)
    empty = reg.limit(0)
    return latest(register(empty, reg)).select("version", "path", "ts")


def q_registry_list(spark, sf):
    reg = T_.registry(spark, sf)
    return register(reg.limit(0), reg).select("version", "ts")


def q_feedback_join(spark, sf):
    features = lambda df: with_url_features(df, similarity=False, flags=False)
    return K.feedback_join(T_.feedback(spark, sf), features, ["url_length", "dots", "has_ip"]).select(
        "url", "true_label", "url_length", "dots", "has_ip"
    )


# ------------------------------------------------------------- evaluation ----


def both_scored(spark, sf):
    return {"docs": T_.scored_docs(spark, sf), "urls": T_.scored_urls(spark, sf)}


def q_confusion(spark, sf):
    out = [E.confusion(df, 0.5).select(F.lit(k).alias("data"), "*") for k, df in both_scored(spark, sf).items()]
    return out[0].unionByName(out[1])


def q_point_metrics(spark, sf):
    # the metrics read their input twice, the URLs are parsed once
    scored = {k: written(df.select("label", "score"), "scored") for k, df in both_scored(spark, sf).items()}
    out = [E.binary_metrics(df, 0.5).select(F.lit(k).alias("data"), "*") for k, df in scored.items()]
    both = out[0].unionByName(out[1])
    return both.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in both.dtypes])


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Doubles rounded to six places, or to the digits given for a column."""
    return df.select(
        *[F.round(c, digits.get(c, 6)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def q_threshold_scan(spark, sf):
    scan_rows = E.scan_thresholds(T_.scored_docs(spark, sf))
    return rounded(scan_rows, threshold=12)


def q_select_thresholds(spark, sf):
    return rounded(E.select_thresholds(E.scan_thresholds(T_.scored_docs(spark, sf))), threshold=12)


def q_roc_curve(spark, sf):
    curve = E.roc_curve(T_.scored_docs(spark, sf))
    start = F.col("threshold") > 1
    return rounded(curve.withColumn("threshold", F.when(~start, F.col("threshold"))))


def q_roc_auc(spark, sf):
    return rounded(E.roc_auc(T_.scored_docs(spark, sf)))


def q_pr_curve(spark, sf):
    return rounded(E.pr_curve(T_.scored_docs(spark, sf)))


def q_avg_precision(spark, sf):
    return rounded(E.average_precision(T_.scored_docs(spark, sf)))


def q_calibration_curve(spark, sf):
    return rounded(E.calibration_curve(T_.scored_docs(spark, sf)))


def q_bootstrap_ci(spark, sf):
    return rounded(bootstrap_ci(T_.scored_docs(spark, sf), 0.5, QUICK.bootstrap_iters))


def q_conformal_fit(spark, sf):
    return rounded(E.conformal_fit(T_.scored_docs(spark, sf)))


def _fitted_q(spark, sf) -> float:
    return E.conformal_fit(T_.scored_docs(spark, sf)).first()["q"]


def q_conformal_sets(spark, sf):
    out = E.conformal_sets(T_.scored_docs(spark, sf), _fitted_q(spark, sf))
    return out.select("id", *[F.col(c).cast("int").alias(c) for c in ("in0", "in1", "abstain")])


def q_conformal_coverage(spark, sf):
    return rounded(E.conformal_coverage(T_.scored_docs(spark, sf), _fitted_q(spark, sf)))


def q_dataset_counts(spark, sf):
    return E.dataset_counts(url_corpus(spark, sf))


def q_stratified_split(spark, sf):
    return E.dataset_counts(stratified_split(url_corpus(spark, sf), KEY), ["part"])


def q_stratified_folds(spark, sf):
    return E.dataset_counts(stratified_folds(url_corpus(spark, sf), KEY), ["fold"])


def q_half_split(spark, sf):
    """The halves of the test part: one for calibration, one for evaluation."""
    split = stratified_split(url_corpus(spark, sf), KEY)
    return E.dataset_counts(half_split(split.filter("part = 'test'"), KEY), ["half"])


def q_active_queue(spark, sf):
    queue = K.active_queue(T_.scored_docs(spark, sf))
    return queue.select("id", r6("uncertainty").alias("uncertainty"), "score")


# ------------------------------------------------------------------ drift ----


def _drift_sides(spark, sf):
    """The pages' own URLs against all URLs of the corpus."""
    corpus = url_corpus(spark, sf)
    features = lambda df: with_url_features(df, flags=False)
    return features(corpus.filter("variant = 0")), features(corpus)


LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def q_psi_drift(spark, sf):
    """Line items that were returned or refused against all the others."""
    lines = spread(table(spark, sf, "lineitem").select("l_returnflag", *LINE_COLUMNS), *LINE_COLUMNS)
    return rounded(D.psi(lines.filter("l_returnflag = 'N'"), lines.filter("l_returnflag <> 'N'"), LINE_COLUMNS))


def q_drift_report(spark, sf):
    ref, cur = _drift_sides(spark, sf)
    return rounded(D.drift_report(ref, cur, CONTINUOUS_FEATURES))


# --------------------------------------------------------------- learning ----


def q_ngram_counts(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select(F.explode(char_ngrams(F.col("url"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


def q_scaled_features(spark, sf):
    """Mean and population deviation of each scaled feature, all in one pass."""
    names = list(CONTINUOUS_FEATURES)
    parsed = with_url_features(url_corpus(spark, sf), flags=False).filter("error IS NULL")
    stats = [
        F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")) for c in names
    ]
    return rounded(parsed.agg(F.array(*stats).alias("s")).select(F.inline("s")))


def measured(model, rows: DataFrame) -> DataFrame:
    """Point metrics of a model; they read their input twice, the rows are scored once."""
    scored = model.score(rows).select("label", F.col("probability").alias("score"))
    return E.binary_metrics(written(scored, "test-scores"), 0.5)


def _fit_and_measure(kind: str, cfg: JobConfig = QUICK) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = stratified_split(T_.feature_table(spark, sf), KEY)
        model = fit_model(rows.filter("part = 'train'"), kind, cfg, KEY)
        return rounded(measured(model, rows.filter("part = 'test'")))

    return run


def q_calibrate(spark, sf):
    rows = stratified_split(T_.feature_table(spark, sf), KEY)
    fit = lambda df: fit_model(df, "sgd", QUICK, KEY)
    out = None
    for method in ("sigmoid", "isotonic"):
        model = calibrate(rows.filter("part = 'train'"), fit, method, 3, KEY)
        one = measured(model, rows.filter("part = 'test'")).select(F.lit(method).alias("method"), "*")
        out = one if out is None else out.unionByName(one)
    return rounded(out)


def q_cross_validate(spark, sf):
    fit = lambda df: fit_model(df, "sgd", QUICK, KEY)
    return rounded(cross_validate(T_.feature_table(spark, sf), fit, QUICK.cv_folds, key=KEY))


def q_perm_importance(spark, sf):
    """Importance on the held-out part for a forest that was fitted on the other part."""
    rows = stratified_split(T_.feature_table(spark, sf), KEY)
    forest = fit_model(rows.filter("part = 'train'"), "rf", QUICK, KEY)
    return rounded(
        permutation_importance(
            rows.filter("part = 'test'"), forest.score, QUICK.permutation_repeats, key="url_id",
            tested=tested_features(forest), grams=gram_stage(QUICK.ngram_dim), model=forest,
        )
    )


def q_top_contributions(spark, sf):
    """The three features that move a fixed small forest most, for every readable URL."""
    parsed = with_url_features(url_corpus(spark, sf), similarity=False, flags=False).filter(F.col("error").isNull())
    explained = with_contributions(
        parsed.select("url_id", *T_.SMALL_FOREST_FEATURES), T_.small_forest_leaves(), path_table(T_.small_forest_nodes(spark)), list(T_.SMALL_FOREST_FEATURES)
    )
    ranked = explained.select("url_id", "base_value", F.posexplode(top_contributions(3)).alias("pos", "top"))
    return ranked.select("url_id", (F.col("pos") + 1).alias("rank"), F.col("top.key").alias("feature"), r6("top.value").alias("amount"), r6("base_value").alias("base_value"))


def q_tree_contributions(spark, sf):
    explained = tree_contributions(T_.feature_table(spark, sf), T_.forest(spark, sf))
    return rounded(
        explained.select("url_id", "base_value", F.explode("contributions").alias("feature", "amount"))
    )


def q_mutated_urls(spark, sf):
    positives = url_corpus(spark, sf).filter("label = 1").select("url_id", "url")
    return X.mutate_urls(positives).select("url_id", "mutator", "repeat", "url")


def q_adversarial_probe(spark, sf):
    trained = TrainedModel(T_.forest(spark, sf), 0.5, None, 0, None, "forest")
    positives = url_corpus(spark, sf).filter("label = 1")
    return rounded(X.adversarial_probe(positives, lambda df: verdicts(df, trained)))


def q_online_update(spark, sf):
    parsed = with_url_features(T_.feedback(spark, sf), flags=False).filter("error IS NULL")
    batch = parsed.select(F.col("true_label").alias("label"), *FEATURES)
    state = online_update(empty_state(), batch, rate=EPOCH_RATE)
    # weights of counts can lie exactly between two numbers of six places
    return rounded(state_table(spark, state).select("feature", "n", "mean", "scale", "coef", "intercept"), coef=9)


def q_model_roundtrip(spark, sf):
    """Scores of a saved and re-read model against those of the model in memory."""
    trained = TrainedModel(T_.forest(spark, sf), 0.5, 0.4, 10, None, "forest", online=empty_state())
    folder = new_folder(spark, "model")
    trained.save(spark, folder)
    back = load_model(spark, folder)
    rows = T_.feature_table(spark, sf).select("url_id", "url", *FEATURES)
    a = trained.model.score(rows).withColumnRenamed("probability", "before")
    both = back.model.score(a)
    return both.select("url_id", r6("before").alias("before"), r6("probability").alias("after"))


def q_report_tables(spark, sf):
    """A whole training run written as report tables, counted per section."""
    cfg = QUICK
    _, tables = train(url_corpus(spark, sf), cfg, KEY)
    folder = new_folder(spark, "report")
    S.write_report(tables, folder)
    out = None
    for name in sorted(tables):
        one = spark.read.parquet(f"{folder}/{name}").agg(F.lit(name).alias("section"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def q_watch_scan(spark, sf):
    """The corpus as line files, scored by the stream until all files are read."""
    lines, out, mark = (new_folder(spark, n) for n in ("watch-in", "watch-out", "watch-mark"))
    url_corpus(spark, sf).select("url").write.text(lines)
    query = watch(
        spark, lines, out, mark, linear_scorer(), T_.rules(spark), T_.watchlist(spark), trigger={"availableNow": True}
    )
    query.awaitTermination()
    return spark.read.parquet(out).select("url", "probability", "verdict", "risk", F.size("reasons").alias("n_reasons"))


def q_top_risk(spark, sf):
    """Flagship: parse, explain and rank the corpus without any trained model."""
    out = scan(url_corpus(spark, sf), rules=T_.rules(spark))
    return out.orderBy(F.desc("risk"), "url_id").limit(20).select(
        "url_id", "url", "risk", F.size("reasons").alias("n_reasons"), F.col("reasons")[0]["text"].alias("top_reason")
    )


QUERIES: dict[str, Query] = {
    "url_corpus": url_corpus,
    "url_lines": q_url_lines,
    "page_links": q_links,
    "parse_errors": q_parse_errors,
    "url_parts": q_url_parts,
    "url_features": q_url_features,
    "brand_distance": q_brand_distance,
    "brand_jaro_winkler": q_brand_jaro_winkler,
    "url_flags": q_url_flags,
    "url_tokens": q_url_tokens,
    "char_entropy": q_char_entropy,
    "shortener_semi": q_shortener_semi,
    "rules_table": q_rules_table,
    "rule_hits": q_rule_hits,
    "heuristic_reasons": q_heuristic_reasons,
    "reason_sums": q_reason_sums,
    "risk_score": q_risk_score,
    "top_risk": q_top_risk,
    "watchlist_override": q_watchlist_override,
    "watchlist_joined": q_watchlist_joined,
    "rules_joined": q_rules_joined,
    "scan_batch": q_scan_batch,
    "scan_linear": q_scan_linear,
    "scan_json": q_scan_json,
    "distinct_score": q_distinct_score,
    "unseen_urls": q_unseen_urls,
    "export_csv": q_export_csv,
    "stix_indicators": q_stix_indicators,
    "alerts": q_alerts,
    "audit_append": q_audit_append,
    "feedback_append": q_feedback_append,
    "audit_recent": q_audit_recent,
    "recent_urls": q_recent_urls,
    "hourly_verdicts": q_hourly_verdicts,
    "live_counters": q_live_counters,
    "registry_latest": q_registry_latest,
    "registry_list": q_registry_list,
    "feedback_join": q_feedback_join,
    "confusion": q_confusion,
    "point_metrics": q_point_metrics,
    "threshold_scan": q_threshold_scan,
    "select_thresholds": q_select_thresholds,
    "roc_curve": q_roc_curve,
    "roc_auc": q_roc_auc,
    "pr_curve": q_pr_curve,
    "avg_precision": q_avg_precision,
    "calibration_curve": q_calibration_curve,
    "bootstrap_ci": q_bootstrap_ci,
    "conformal_fit": q_conformal_fit,
    "conformal_sets": q_conformal_sets,
    "conformal_coverage": q_conformal_coverage,
    "dataset_counts": q_dataset_counts,
    "stratified_split": q_stratified_split,
    "stratified_folds": q_stratified_folds,
    "half_split": q_half_split,
    "active_queue": q_active_queue,
    "psi_drift": q_psi_drift,
    "drift_report": q_drift_report,
    "ngram_counts": q_ngram_counts,
    "scaled_features": q_scaled_features,
    "train_rf": _fit_and_measure("rf", JobConfig()),
    "train_et": _fit_and_measure("extratrees"),
    "train_gbt": _fit_and_measure("hgb", JobConfig()),
    "train_lr": _fit_and_measure("sgd"),
    "train_voting": _fit_and_measure("voting"),
    "train_stack": _fit_and_measure("stack"),
    "calibrate": q_calibrate,
    "cross_validate": q_cross_validate,
    "perm_importance": q_perm_importance,
    "tree_contributions": q_tree_contributions,
    "top_contributions": q_top_contributions,
    "mutated_urls": q_mutated_urls,
    "adversarial_probe": q_adversarial_probe,
    "online_update": q_online_update,
    "model_roundtrip": q_model_roundtrip,
    "report_tables": q_report_tables,
    "watch_scan": q_watch_scan,
}
