"""Parsing and features on edge rows, against the standard library and hand-worked values."""

import math
import unicodedata
from collections import Counter
from urllib.parse import parse_qsl, urlparse

import pytest
from pyspark.sql import functions as F

from linksift.constants import CONTINUOUS_FEATURES, FEATURES, PASSTHROUGH_FEATURES
from linksift.functions.similarity import best_brand_likeness, jaro_winkler_block
from linksift.functions.text import shannon
from linksift.operators.parse import require_features, with_tokens, with_url_features, with_url_parts

SPLIT_CASES = [
    "http://user:pw@Host.Example.com:8080/a/b;v=1/c;p=2?x=1&y=%20#frag?no",
    "HTTPS://EXAMPLE.com?q=a/b#c",
    "http://example.com#a?b",
    "http://[::1]:8443/x",
    "http://[2001:db8::a]:80",
    "http://[::ffff:1.2.3.4]/",
    "http://host:abc/",
    "http://host:99999/",
    "http://host:0/",
    "http://host:/p",
    "ftp://h/a;type=i",
    "custom+x://h/a;b",
    "http://a b c/d e?f g",
    "http://пример.рф/путь?ключ=знач",
    "http:///nohost/path",
    "data://text/html,x",
    "http://a_b.example.com/",
    "1http://x/y",
    "http://x/;a/b;c",
    "http://a@b@c/d",
]


def stdlib_parts(url):
    u = urlparse(url)
    try:
        port = u.port
    except ValueError:
        port = None
    return (u.scheme.lower(), (u.hostname or "").lower(), port, u.path, u.query)


def test_split_equals_standard_library(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(SPLIT_CASES)], "i int, url string")
    got = {r.i: r for r in with_url_parts(df).collect()}
    for i, url in enumerate(SPLIT_CASES):
        r = got[i]
        assert r.error is None, url
        assert (r.u_scheme, r.u_host, r.u_port, r.u_path, r.u_query) == stdlib_parts(url), url


@pytest.mark.parametrize(
    "url, error",
    [
        (None, "empty url"),
        ("", "empty url"),
        (" \t\u3000\n ", "empty url"),
        ("http://" + "a" * 8186, "url too long (max 8192)"),
        ("http://" + "a" * 8185, None),
        ("http://[::1/x", "could not parse url: Invalid IPv6 URL"),
        ("http://::1]/x", "could not parse url: Invalid IPv6 URL"),
        ("http://[zz]/x", "could not parse url: 'zz' does not appear to be an IPv4 or IPv6 address"),
    ],
)
def test_errors_keep_the_row(spark, url, error):
    row = with_url_features(spark.createDataFrame([(url,)], "url string")).first()
    assert row.error == error
    assert (row.url_length is None) == (error is not None)


def test_nul_is_refused_on_request(spark):
    df = spark.createDataFrame([("http://a.b/\0c",)], "url string")
    assert with_url_features(df, reject_nul=True).first().error is not None
    assert with_url_features(df).first().error is None


def test_unicode_is_normalised(spark):
    texts = ["http://ｅｘａｍｐｌｅ.com/１２３４５６", "http://a\u200bb.com/\u00adx", "http://x.com/😀é", "http://ﬁ.com/②"]
    rows = with_url_parts(spark.createDataFrame([(t,) for t in texts], "url string")).collect()
    for text, row in zip(texts, rows):
        nfc = unicodedata.normalize("NFC", unicodedata.normalize("NFKC", text))
        assert row.u_full == "".join(c for c in nfc if unicodedata.category(c)[0] != "C")


def entropy(s):
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values()) if s else 0.0


def test_entropy(spark):
    words = ["", "a", "aaaa", "http://a.b/aaa", "ab" * 500, "😀x😀", "line\nbreak\n\n", "z" * 30000, "войти"]
    rows = spark.createDataFrame([(w,) for w in words], "s string").select("s", shannon(F.col("s")).alias("h")).collect()
    for r in rows:
        assert r.h == pytest.approx(entropy(r.s), abs=1e-9)
    assert entropy("http://a.b/aaa") == pytest.approx(2.753434, abs=1e-6)


def test_query_fields_equal_standard_library(spark):
    queries = ["a=1&b=2", "a&b=&=c", "&&x=1&", "k%20y=1&z%zz=2", "a+b=1", "%41%4=1", "ключ=1"]
    df = spark.createDataFrame([(q, f"http://h/?{q}") for q in queries], "q string, url string")
    for r in with_url_features(df, similarity=False, flags=False).collect():
        keys = [k for k, _ in parse_qsl(r.q, keep_blank_values=True)]
        assert r.params == len(keys), r.q
        assert r.key_entropy == pytest.approx(entropy("".join(keys)), abs=1e-9), r.q


# url -> features that are worked out by hand
GOLDEN = {
    "http://steam-account-alert.ga/confirm?case=12345": dict(
        url_length=48, dots=1, hyphens=2, digits=5, slashes=3, question_marks=1, equals_signs=1, path_length=8,
        query_length=10, suspicious_tld=1, brand_in_subdomain=1, params=1, tld_length=2, path_depth=1, https=0,
        brand_distance=99.0, jaro_winkler_brand=0.0, scheme_risk=1.0, max_digit_run=5, domain_length=22,
    ),
    "https://goo.gl/3xYz9": dict(https=1, ssl_hint=1, tld_length=2, path_tokens=1, max_token=5, brand_in_subdomain=0, brand_distance=2.0),
    "http://xn--mazon-3ve.com/orders/renew": dict(punycode=1, path_depth=2, path_tokens=2, subdomains=0),
    "http://аdobe.com/orders": dict(homoglyph=1, brand_distance=1.0, unicode_mix=1 / 23, digits=0),
    "http://10.20.30.40/panel/signin.php?member=root": dict(has_ip=1, tld_length=0, subdomains=2, digits=8, max_digit_run=2),
    "http://user@evil.example.com:8080//redirect?url=x": dict(
        has_at=1, double_slash=1, port=1, contains_port_8080=1, encoded_redirect=1, authority_length=22, subdomains=1
    ),
    "http://0xC0A80001/f.pdf.html": dict(ip_in_hex=1, double_extension=1),
    "http://x.top/??win!!!": dict(consecutive_question_marks=1, exclamation_marks=3, suspicious_tld=1, params=1),
    "paypal.com.verify.xyz/x.zip": dict(ends_with_zip=1, scheme_risk=1.0, brand_distance=0.0, jaro_winkler_brand=1.0),
    "http://paypa1.com/": dict(brand_distance=1.0, jaro_winkler_brand=0.9333333333333333),
    "http://h.com/deadbeefcafebabe": dict(hex_encoding=1),
    "http://h.com/xdeadbeefcafebabe": dict(hex_encoding=0),
}


def test_golden_features(spark):
    rows = with_url_features(spark.createDataFrame([(u,) for u in GOLDEN], "url string")).collect()
    for r in rows:
        for name, value in GOLDEN[r.url].items():
            assert r[name] == pytest.approx(value, abs=1e-9), (r.url, name)


def test_flags_and_tokens(spark):
    url = "http://xn--e1afmkfd.com/login/deadbeefcafe?A=b"
    row = with_tokens(with_url_features(spark.createDataFrame([(url,)], "url string"), keep_parts=True)).first()
    assert row.flags.punycode_decoded == "пример.com"
    assert row.flags.suspicious_words == ["login"]
    assert [(t.kind, t.text) for t in row.tokens] == [
        ("scheme", "http://"), ("punycode", "xn--e1afmkfd"), ("sep", "."), ("host", "com"), ("sep", "/"), ("word", "login"),
        ("sep", "/"), ("hex", "deadbeefcafe"), ("sep", "?"), ("path", "A"), ("sep", "="), ("path", "b"),
    ]


def test_likeness_is_symmetric_and_one_on_equality():
    words = ["paypal", "payapl", "paypa1"]
    m = jaro_winkler_block(words, words)
    assert abs(m - m.T).max() < 1e-12
    assert m.diagonal().tolist() == [1.0] * 3
    assert best_brand_likeness(["ab", "paypal", "q" * 40]).tolist() == [0.0, 1.0, 0.0]


def test_feature_lists(spark):
    assert len(FEATURES) == 50 and len(CONTINUOUS_FEATURES) == 31 and len(PASSTHROUGH_FEATURES) == 19
    with pytest.raises(ValueError, match="url_length"):
        require_features(spark.range(1))


def test_plan_has_no_shuffle(spark, sf):
    from linksift.operators.scoring import scan
    from linksift.operators.reasons import default_rules
    from linksift.sources.tables import table

    plan = scan(table(spark, sf, "pages").select("url"), rules=default_rules(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "html" not in plan


def test_filters_on_carried_columns_reach_the_scan(spark, sf, tmp_path):
    from linksift.operators.reasons import default_rules
    from linksift.operators.scoring import scan
    from linksift.sources.tables import table

    pages = table(spark, sf, "pages").selectExpr("url", "concat('d', page_id % 3) AS day", "page_id")
    pages.write.partitionBy("day").parquet(str(tmp_path / "pages"))
    days = spark.read.parquet(str(tmp_path / "pages"))
    for out in (with_url_features(days), scan(days, rules=default_rules(spark))):
        one = out.filter("day = 'd1' AND page_id > 5")
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThan(page_id,5)" in plan
        # a filter on a result does not copy the work below it
        high = out.filter("url_length > 3 AND has_at = 0")._jdf.queryExecution().executedPlan().toString()
        assert high.count("regexp_replace") <= out._jdf.queryExecution().executedPlan().toString().count("regexp_replace")
        assert one.count() == out.filter("day = 'd1'").filter("page_id > 5").count() > 0
