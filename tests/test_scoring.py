"""Reasons, rules, risk, sinks and the scan."""

import json

import pytest
from pyspark.sql import functions as F

from linksift.operators.containment import containing
from linksift.operators.parse import with_url_features, with_url_parts
from linksift.operators.reasons import RULES_SCHEMA, apply_rules, apply_watchlist, default_rules
from linksift.operators.scoring import Scorer, alerts, fit_risk, plain_risk, scan, with_risk
from linksift.plans import fixtures as T_
from linksift.sinks import writers as S
from linksift.sources.tables import read_rules, read_watchlist, url_lines


def urls(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "url string")


def hits(spark, url, *rules):
    parsed = with_url_features(urls(spark, url), similarity=False, keep_parts=True)
    out = apply_rules(parsed, spark.createDataFrame([(*r, True) for r in rules], RULES_SCHEMA)).first()
    return [r.text for r in out.rule_reasons]


def test_rule_kinds_and_order(spark):
    rules = [
        ("b", "EXAMPLE", "low", 0.1, "contains"), ("a", "^http", "low", 0.1, "regex"), ("bad", "(", "low", 0.1, "regex"),
        ("named", r"(?P<x>e)xample.(?P=x)", "low", 0.1, "regex"), ("host", "example.com", "low", 0.1, "host_equals"),
        ("tld", "com", "low", 0.1, "tld"), ("pre", "HTTP:", "low", 0.1, "prefix"), ("suf", "/END", "low", 0.1, "suffix"),
        ("odd", "x", "low", 0.1, "other"),
    ]
    assert hits(spark, "http://example.com/end", *rules) == [f"rule: {n}" for n in ("b", "a", "host", "tld", "pre", "suf")]


def test_many_rules_need_several_steps(spark):
    rules = [(f"r{i}", f"x{i}/", "low", 0.1, "contains") for i in range(450)]
    assert hits(spark, "http://h/x3/x449/", *rules) == ["rule: r3", "rule: r449"]


def test_default_rules_hit_literal_prefixes(spark):
    parsed = with_url_features(urls(spark, "javascript:alert(1)", "data:text/html,x"), similarity=False, keep_parts=True)
    found = [r.rule_reasons[0].text for r in apply_rules(parsed, default_rules(spark)).collect()]
    assert found == ["rule: javascript_uri", "rule: data_uri"]


def test_rules_file(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"rules": [{"name": "n", "pattern": "p"}]}))
    row = read_rules(spark, str(path)).first()
    assert tuple(row) == ("n", "p", "medium", 0.4, "contains", True)
    path.write_text("{not json")
    assert read_rules(spark, str(path)).count() == 13
    assert read_rules(spark, str(tmp_path / "absent.json")).count() == 13


def test_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b" http://a/ \n\n\t\nhttp://b/\xff\n")
    got = [r.url for r in url_lines(spark, str(tmp_path), ["http://first/ ", " "]).collect()]
    assert got == ["http://first/", "http://a/", "http://b/"]
    (tmp_path / "a.txt").write_text("http://c/\x0b http://d/\u2028\x85http://e/\ufffd\n")
    assert [r.url for r in url_lines(spark, str(tmp_path)).collect()] == ["http://c/", "http://d/", "http://e/\ufffd"]


def test_watchlist_overrides(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps([" EVIL ", ""]))
    watch = read_watchlist(spark, str(tmp_path / "w.json"))
    row = scan(urls(spark, "https://Evil.com/"), Scorer(threshold=0.9), watchlist=watch).first()
    assert (row.risk, row.verdict, row.abstain) == (100, 1, False)
    assert row.reasons[-1].severity == "critical"


def test_containing_against_brute_force(spark):
    """Short, long, non-ASCII, repeated and empty needles, in short and empty texts too."""
    texts = ["", "a", "abc", "abcd", "abcdabcd", "http://ab.cd/ef", "héllo wörld", "😀😀x", None, "abc", "x" * 3000 + "needle"]
    needles = ["", "a", "bc", "abc", "abcd", "dabc", "wörl", "ö", "😀x", "needle", "xneedle", "nowhere", "http://ab.cd/ef", "longer than any", None, "abcd"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    entries = spark.createDataFrame(list(enumerate(needles)), "entry_id int, needle string")
    got = sorted(tuple(r) for r in containing(df, entries).collect())
    assert got == sorted({(t, i) for t in texts if t for i, n in enumerate(needles) if n and n in t})
    assert containing(df, entries.limit(0)).count() == 0 and containing(df.limit(0), entries).count() == 0


def test_many_rules_and_entries_are_joined(spark, sf):
    """The joined way gives the literal way's rows, in rule order, for null, blank and broken URLs as well."""
    given = [None, " ", "http://a.tk/login", "http://A.tk/login", "https://verify.example.com/x.html", "http://x.com/?case=1"]
    corpus = with_url_parts(urls(spark, *given))
    many = T_.rules(spark).unionByName(spark.createDataFrame([("all", "", "low", 0.1, "contains", True), ("host", "a.tk", "low", 0.3, "host_equals", True)], T_.rules(spark).schema))
    plain, joined = apply_rules(corpus, many), apply_rules(corpus, many, most_literals=0)
    assert joined.columns == plain.columns
    assert sorted(joined.collect(), key=str) == sorted(plain.collect(), key=str)
    watch = spark.createDataFrame([(" TK/",), ("",), (None,), ("é",), ("case=1",)], "entry string")
    plain, joined = apply_watchlist(corpus, watch), apply_watchlist(corpus, watch, most_literals=0)
    assert joined.columns == plain.columns
    assert sorted(joined.collect(), key=str) == sorted(plain.collect(), key=str)


def test_a_hundred_thousand_entries(spark):
    """A long list costs no plan of its own size."""
    watch = spark.range(100_000).select(F.concat(F.lit("/case-"), "id", F.lit("-end")).alias("entry"))
    df = spark.range(400).select(F.concat(F.lit("http://h"), F.col("id"), F.lit(".com/CASE-"), F.col("id") * 500, F.lit("-end?x")).alias("url"))
    out = scan(df, Scorer(threshold=0.9), watchlist=watch)
    assert len(out._jdf.queryExecution().analyzed().toString()) < 400_000
    assert [r.n for r in out.groupBy("verdict").agg(F.count("*").alias("n")).orderBy("verdict").collect()] == [200, 200]


def test_risk_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.125, 0.0), (0.375, 0.0)], "p double, s double")
    # 100 * 0.6 * p = 7.5 and 22.5
    assert [r[0] for r in df.select(plain_risk(F.col("p"), F.col("s"))).collect()] == [8, 22]


def test_isotonic_risk_grows_with_probability(spark):
    rows = [(i / 50, 0.0, 0.0, int(i % 7 + i / 8 > 6)) for i in range(50)]
    df = spark.createDataFrame(rows, "probability double, reason_sum double, rule_sum double, label int")
    risks = [r.risk for r in with_risk(df, fit_risk(df)).orderBy("probability").collect()]
    assert risks == sorted(risks) and 0 <= risks[0] and risks[-1] <= 100


def test_error_rows_come_through(spark):
    row = scan(urls(spark, " "), Scorer(conformal_q=0.1, threshold=0.0)).first()
    assert (row.probability, row.verdict, row.risk, row.abstain, row.error) == (0.0, 0, 0, False, "empty url")
    assert [r.text for r in row.reasons] == ["could not parse: empty url"]


def test_sinks(spark, tmp_path):
    scored = scan(urls(spark, "http://user@xn--a.tk/o'x\\y"), rules=default_rules(spark))
    S.write_stix(scored, str(tmp_path / "stix"))
    bundle = json.loads(spark.read.text(str(tmp_path / "stix")).first()[0])
    assert bundle["type"] == "bundle" and bundle["id"].startswith("bundle--") and len(bundle["objects"]) == 1
    obj = bundle["objects"][0]
    assert obj["pattern"] == "[url:value = 'http://user@xn--a.tk/o\\'x\\\\y']"
    assert obj["confidence"] == 50 and obj["id"].startswith("indicator--")
    S.append_predictions(scored, str(tmp_path / "log"), 0.5)
    S.append_predictions(scored, str(tmp_path / "log"), 0.5)
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 2 and log.select("id").distinct().count() == 2
    assert alerts(scored, min_risk=0).first().prediction == 1
