"""The same queries in SQL for DuckDB, to check the Spark results against."""

from __future__ import annotations

from linksift.constants import (
    BRANDS,
    CONTINUOUS_FEATURES,
    DEFAULT_RULES,
    DOUBLE_FEATURES,
    FEATURES,
    LOOKALIKE_FOR,
    SIMILARITY_FREE_SCORE,
    SUSPICIOUS_TLDS,
    SUSPICIOUS_WORDS,
    URL_SHORTENERS,
    HOMOGLYPHS,
)
from linksift.operators.evaluate import GRID_QUANTILES, GRID_STEPS
from linksift.plans.fixtures import EXTRA_RULES, SMALL_FOREST, SMALL_FOREST_FEATURES, WATCH_ENTRIES
from linksift.sources.corpus import BAD_HOST_PARTS, VARIANTS


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def items(values) -> str:
    return ", ".join(q(v) for v in values)


def lst(values) -> str:
    return "[" + items(values) + "]"


def d(x: float) -> str:
    """A literal that is read as exactly this double."""
    return f"CAST('{x!r}' AS DOUBLE)"


# ---------------------------------------------------------------- corpus ----

_VARIANT_ROWS = ", ".join(f"({v}, {q(t)}, {l})" for v, t, l in VARIANTS)
CORPUS = f"""corpus0 AS (
  SELECT page_id, 0 AS variant, url,
         CASE WHEN contains(url, {q(BAD_HOST_PARTS[0])}) OR contains(url, {q(BAD_HOST_PARTS[1])}) THEN 1 ELSE 0 END AS label
  FROM pages
  UNION ALL
  SELECT page_id, v.variant, replace(v.template, '{{id}}', CAST(page_id AS VARCHAR)), v.label
  FROM pages, (VALUES {_VARIANT_ROWS}) AS v(variant, template, label)
), corpus AS (
  SELECT page_id * 100 + variant AS url_id, page_id, variant, url,
         CASE WHEN (page_id * 100 + variant) % 50 = 7 THEN 1 - label ELSE label END AS label
  FROM corpus0
)"""

PARTS = r"""trimmed AS (
  SELECT *, trim(url) AS u_trim,
         CASE WHEN trim(url) = '' THEN 'empty url' WHEN length(trim(url)) > 8192 THEN 'url too long (max 8192)' END AS error
  FROM corpus
), fulls AS (
  SELECT *, CASE WHEN error IS NULL THEN NOT contains(u_trim, '://') END AS implicit,
         CASE WHEN error IS NULL THEN CASE WHEN contains(u_trim, '://') THEN u_trim ELSE 'http://' || u_trim END END AS u
  FROM trimmed
), cut AS (
  SELECT *, regexp_extract(u, '^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?',
                           ['scheme', 'netloc', 'path', 'query']) AS g
  FROM fulls
), hosts AS (
  SELECT *, lower(g.scheme) AS scheme, g.query AS query,
         regexp_replace(g.path, '^((?:.*/)?[^/;]*);[^/]*$', '\1') AS path,
         regexp_replace(g.netloc, '^.*@', '') AS info
  FROM cut
), ported AS (
  SELECT *, lower(CASE WHEN contains(info, '[') THEN regexp_extract(info, '\[([^\]]*)', 1)
                       ELSE regexp_extract(info, '^([^:]*)', 1) END) AS host,
         TRY_CAST(regexp_extract(info, ':([0-9]+)$', 1) AS INTEGER) AS port
  FROM hosts
), labelled AS (
  SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS labels FROM ported
), parts AS (
  SELECT *, CASE WHEN error IS NOT NULL THEN NULL
                 WHEN len(labels) >= 2 AND (regexp_full_match(labels[-1], '[a-zЀ-ӿ]{2,24}') OR starts_with(labels[-1], 'xn--'))
                 THEN labels[-1] ELSE '' END AS tld
  FROM labelled
)"""


def _count(char: str) -> str:
    return f"length(u) - length(replace(u, {q(char)}, ''))"


def _entropy(text: str) -> str:
    return f"coalesce(list_aggregate(string_split({text}, ''), 'entropy'), 0.0)"


_ANY_BRAND = f"len(list_filter({lst(BRANDS)}, lambda b: contains({{0}}, b))) > 0"
_SQL_FEATURES = {
    "url_length": "greatest(1, length(u))",
    "dots": _count("."),
    "hyphens": _count("-"),
    "digits": "length(regexp_replace(u, '[^0-9]', '', 'g'))",
    "slashes": _count("/"),
    "question_marks": _count("?"),
    "equals_signs": _count("="),
    "ampersands": _count("&"),
    "percents": _count("%"),
    "path_length": "length(path)",
    "query_length": "length(query)",
    "has_at": "contains(u, '@')",
    "has_ip": r"regexp_full_match(host, '(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])){3}')",
    "double_slash": "contains(path, '//') OR contains(query, '//')",
    "punycode": "starts_with(host, 'xn--') OR contains(host, '.xn--')",
    "hex_encoding": r"regexp_matches(u, '(%[0-9A-Fa-f]{2}){3,}') OR regexp_matches(u, '\b[0-9A-Fa-f]{16,}\b')",
    "subdomains": "greatest(0, len(labels) - 2)",
    "domain_length": "length(host)",
    "suspicious_tld": f"tld IN ({items(SUSPICIOUS_TLDS)})",
    "digit_ratio": "CAST(length(regexp_replace(u, '[^0-9]', '', 'g')) AS DOUBLE) / greatest(1, length(u))",
    "hyphen_ratio": f"CAST({_count('-')} AS DOUBLE) / greatest(1, length(u))",
    "https": "scheme = 'https'",
    "ssl_hint": f"scheme = 'https' AND tld NOT IN ({items(SUSPICIOUS_TLDS)})",
    "brand_in_subdomain": f"({_ANY_BRAND.format('sub')}) OR (len(labels) >= 2 AND {_count('-')} > 0 AND {_ANY_BRAND.format('last_two')})",
    "url_entropy": _entropy("u"),
    "params": "len(fields)",
    "max_token": "coalesce(list_max(list_transform(tokens, lambda x: length(x))), 0)",
    "tld_length": "length(tld)",
    "port": "coalesce(port NOT IN (80, 443), false)",
    "path_depth": "len(list_filter(string_split(path, '/'), lambda x: x <> ''))",
    "homoglyph": f"regexp_matches(u, '[{''.join(HOMOGLYPHS)}]')",
    "unicode_mix": r"CAST(length(regexp_replace(u, '[\x00-\x7F]', '', 'g')) AS DOUBLE) / length(u)",
    "scheme_risk": "CASE WHEN scheme = 'https' THEN 0.0 WHEN scheme IN ('http', '', 'ftp', 'file', 'data', 'javascript') THEN 1.0 ELSE 0.5 END",
    "double_extension": r"regexp_matches(path, '(?i)\.(pdf|doc|docx|xls|xlsx|jpg|png|txt|zip|exe)\.(html?|php|asp|jsp)$')",
    "key_entropy": _entropy("array_to_string(list_transform(fields, lambda f: url_decode(replace(split_part(f, '=', 1), '+', ' '))), '')"),
    "path_tokens": "len(tokens)",
    "authority_length": "length(host) + CASE WHEN port > 0 THEN 6 ELSE 0 END",
    "encoded_redirect": r"regexp_matches(query, '(?i)(url|redirect|next|return|continue|goto|target)\s*=') OR regexp_matches(u, '(?i)%2f%2f')",
    "max_digit_run": "coalesce(list_max(list_transform(regexp_extract_all(u, '[0-9]+'), lambda x: length(x))), 0)",
    "subdomain_entropy": _entropy("sub"),
    "path_entropy": _entropy("path"),
    "query_entropy": _entropy("query"),
    "ip_in_hex": "regexp_matches(u, '(?i)0x[0-9a-f]{8}')",
    "contains_port_8080": "coalesce(port = 8080, false)",
    "too_many_dots": f"{_count('.')} >= 5",
    "ends_with_zip": "ends_with(lower(path), '.zip')",
    "exclamation_marks": _count("!"),
    "consecutive_question_marks": "contains(u, '??')",
}
PLAIN_FEATURES = [f for f in FEATURES if f in _SQL_FEATURES]


def _cast(f: str, expr: str) -> str:
    kind = "DOUBLE" if f in DOUBLE_FEATURES else "INTEGER"
    return f"CASE WHEN error IS NULL THEN CAST(({expr}) AS {kind}) END"


FEATS = (
    r"""helped AS (
  SELECT *, array_to_string(labels[1:greatest(len(labels) - 2, 0)], '.') AS sub,
         array_to_string(labels[greatest(len(labels) - 1, 1):], '-') AS last_two,
         list_filter(string_split(query, '&'), lambda x: x <> '') AS fields,
         list_filter(regexp_split_to_array(path, '[^A-Za-z0-9Ѐ-ӿ]+'), lambda x: x <> '') AS tokens
  FROM parts
), feats AS (
  SELECT url_id, page_id, variant, url, label, error, u_trim, u, implicit, scheme, host, port AS port_number, path, query, labels, tld,
    """
    + ",\n    ".join(f"{_cast(f, _SQL_FEATURES[f])} AS {f}" for f in PLAIN_FEATURES)
    + f""",
    list_filter({lst(sorted(BRANDS))}, lambda b: contains(lower(u), b)) AS brands,
    list_filter({lst(sorted(SUSPICIOUS_WORDS))}, lambda w: contains(lower(path), w) OR contains(lower(query), w)) AS words,
    host IN ({items(URL_SHORTENERS)}) AS shortener
  FROM helped
)"""
)

# Non-ASCII characters never equal a brand character, so one stand-in for all of
# them leaves every distance and match unchanged, and makes bytes equal characters.
SIMILAR = f"""words AS (
  SELECT DISTINCT regexp_replace(l, '[^\\x00-\\x7F]', '*', 'g') AS l FROM (SELECT unnest(labels) AS l FROM parts WHERE error IS NULL)
), pairs AS (
  SELECT l, b, least(levenshtein(l, b), 4) AS dist, jaro_similarity(l, b) AS jaro,
         CASE WHEN length(l) >= 4 AND length(b) >= 4 AND l[1:4] = b[1:4] THEN 4
              WHEN length(b) >= 3 AND l[1:3] = b[1:3] THEN 3
              WHEN l[1:2] = b[1:2] THEN 2 WHEN l[1:1] = b[1:1] THEN 1 ELSE 0 END AS prefix
  FROM words, (SELECT unnest({lst(BRANDS)}) AS b)
  WHERE length(l) >= 3 AND abs(length(l) - length(b)) <= 3
), nearest AS (
  SELECT l, min(dist) AS dist, max(jaro + prefix * CAST(0.1 AS DOUBLE) * (1 - jaro)) AS jw FROM pairs GROUP BY l
), likeness AS (
  SELECT p.url_id, CAST(coalesce(min(n.dist), 99) AS DOUBLE) AS brand_distance, coalesce(max(n.jw), 0.0) AS jaro_winkler_brand
  FROM (SELECT url_id, unnest(CASE WHEN len(labels) = 0 THEN [''] ELSE labels END) AS l FROM parts WHERE error IS NULL) p
  LEFT JOIN nearest n ON n.l = regexp_replace(p.l, '[^\\x00-\\x7F]', '*', 'g')
  GROUP BY p.url_id
)"""

_Z = " + ".join(
    [d(SIMILARITY_FREE_SCORE["intercept"])]
    + [f"{d(w)} * {f}" for f, w in SIMILARITY_FREE_SCORE.items() if f != "intercept"]
)
SCORED_URLS = f"""scored_urls AS (
  SELECT url_id AS id, url, label,
         CASE WHEN error IS NULL THEN round(1.0 / (1.0 + exp(-({_Z}))), 6) ELSE 0.0 END AS score
  FROM feats
)"""
SCORED_DOCS = """scored_docs AS (
  SELECT doc_id AS id, quality AS label, CAST(n_chars % 1000 AS DOUBLE) / 1000.0 AS score
  FROM documents JOIN labels USING (doc_id)
)"""
PREDICTIONS = """predictions AS (
  SELECT CAST(s.id AS VARCHAR) AS id, e.ts, s.url, s.score AS prob, CASE WHEN s.score >= 0.5 THEN 1 ELSE 0 END AS prediction,
         CAST(round_even(s.score * 100, 0) AS INTEGER) AS risk, 'batch' AS source
  FROM scored_urls s JOIN events e ON e.event_id = s.id % (SELECT count(*) FROM events)
)"""
FEEDBACK = """feedback AS (
  SELECT c.url_id, c.url, c.label AS true_label, 'user' AS source, e.ts FROM corpus c JOIN events e ON e.event_id = c.url_id % (SELECT count(*) FROM events)
)"""

# --------------------------------------------------------------- reasons ----


def _struct(text: str, severity: str, weight: float) -> str:
    return f"{{'text': {text}, 'severity': '{severity}', 'weight': {d(float(weight))}}}"


_REASON_TABLE = [
    ("has_at = 1", q("url contains '@' — real host is masked"), "high", 0.9),
    ("has_ip = 1", q("host is an IP address, not a domain"), "high", 0.9),
    ("suspicious_tld = 1", "'TLD .' || tld || ' — dodgy zone'", "medium", 0.6),
    ("punycode = 1", q("punycode (xn--) — possible homograph attack"), "high", 0.7),
    ("homoglyph = 1", q("contains look-alike characters (homoglyphs)"), "high", 0.8),
    ("double_slash = 1", q("url contains '//' — redirect pattern"), "low", 0.4),
    ("hex_encoding = 1", q("contains hex-encoded characters (%XX)"), "medium", 0.5),
    ("subdomains >= 3", "'many subdomains (' || subdomains || ')'", "low", 0.3),
    ("url_length >= 90", "'url too long (' || url_length || ' chars)'", "low", 0.3),
    (
        "brand_in_subdomain = 1",
        "'brand in subdomain — likely imitation' || CASE WHEN len(brands) > 0 THEN ': ' || array_to_string(brands[1:3], ', ') ELSE '' END",
        "high",
        0.8,
    ),
    ("url_entropy >= 4.3", q("high entropy — looks like a random string"), "low", 0.3),
    ("https = 0", q("no HTTPS"), "medium", 0.4),
    ("shortener", "'url shortener (' || host || ')'", "medium", 0.5),
    ("port = 1", "'non-standard port (' || port_number || ')'", "medium", 0.5),
    ("len(words) > 0", "'data-theft keywords: ' || array_to_string(words[1:4], ', ')", "medium", 0.4),
    ("path_depth >= 6", "'deep path (' || path_depth || ' segments)'", "low", 0.2),
    ("params >= 6", "'many query parameters (' || params || ')'", "low", 0.2),
    ("double_extension = 1", q("double extension (e.g. .pdf.html) — evasion"), "high", 0.8),
    ("encoded_redirect = 1", q("contains encoded redirect"), "medium", 0.5),
    ("max_digit_run >= 6", "'long digit run (' || max_digit_run || ')'", "low", 0.3),
    ("brand_distance <= 1 AND brand_in_subdomain = 0", q("domain almost like a brand — typosquatting"), "high", 0.85),
    ("jaro_winkler_brand >= 0.9 AND brand_distance > 1", q("very similar to a brand (Jaro-Winkler ≥ 0.9)"), "high", 0.75),
    ("ip_in_hex = 1", q("IP address in hex format (0x...)"), "high", 0.7),
    ("too_many_dots = 1", q("too many dots in url"), "low", 0.3),
    ("ends_with_zip = 1", q("url ends with .zip — possible file lure"), "medium", 0.5),
    ("exclamation_marks >= 3", q("many exclamation marks — pressure on user"), "low", 0.25),
]
_HITS = ", ".join(f"CASE WHEN {c} THEN {_struct(t, s, w)} END" for c, t, s, w in _REASON_TABLE)


def _rule_test(kind: str, pattern: str) -> str:
    return {
        "contains": f"contains(lower(u_trim), {q(pattern.lower())})",
        "prefix": f"starts_with(lower(u_trim), {q(pattern.lower())})",
        "suffix": f"ends_with(lower(u_trim), {q(pattern.lower())})",
        "host_equals": f"host = {q(pattern)}",
        "tld": f"tld = {q(pattern)}",
        "regex": f"regexp_matches(u_trim, {q('(?i)' + pattern)})",
    }[kind]


_ALL_RULES = [(*r, True) for r in DEFAULT_RULES] + list(EXTRA_RULES)
_LIVE_RULES = [r for r in _ALL_RULES if r[5] and r[0] not in ("broken", "own_kind")]
_RULE_HITS = ", ".join(
    f"CASE WHEN error IS NULL AND {_rule_test(k, p)} THEN {_struct(q('rule: ' + n), s, w)} END" for n, p, s, w, k, _ in _LIVE_RULES
)


def _sum(reasons: str) -> str:
    return f"coalesce(list_sum(list_transform({reasons}, lambda r: CASE WHEN r.severity = 'info' THEN 0.0 ELSE r.weight END)), 0.0)"


REASONS = f"""reasoned0 AS (
  SELECT f.*, l.brand_distance, l.jaro_winkler_brand FROM feats f LEFT JOIN likeness l USING (url_id)
), reasoned1 AS (
  SELECT *, list_filter([{_HITS}], lambda r: r IS NOT NULL) AS hits,
         list_filter([{_RULE_HITS}], lambda r: r IS NOT NULL) AS rule_reasons
  FROM reasoned0
), reasoned2 AS (
  SELECT *, CASE WHEN error IS NOT NULL THEN [{_struct("'could not parse: ' || error", "high", 1.0)}]
                 WHEN len(hits) > 0 THEN hits ELSE [{_struct(q("nothing suspicious found"), "info", 0.0)}] END AS heuristic
  FROM reasoned1
), reasoned AS (
  SELECT *, list_concat(heuristic, rule_reasons) AS reasons FROM reasoned2
)"""


def risk(p: str) -> str:
    return f"least(100, CAST(round_even(100 * (0.6 * {p} + 0.4 * tanh({_sum('reasons')} / 5.0)), 0) AS INTEGER))"


SCAN = f"""scanned AS (
  SELECT r.*, s.score AS probability, CASE WHEN r.error IS NULL AND s.score >= 0.5 THEN 1 ELSE 0 END AS verdict,
         CASE WHEN r.error IS NULL THEN {risk("s.score")} ELSE 0 END AS risk,
         r.error IS NOT NULL OR greatest(least(s.score, {d(1 - 1e-9)}), {d(1e-9)}) <= {d(0.7)} AS c0,
         r.error IS NOT NULL OR 1 - greatest(least(s.score, {d(1 - 1e-9)}), {d(1e-9)}) <= {d(0.7)} AS c1
  FROM reasoned r JOIN scored_urls s ON s.id = r.url_id
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_P = with_(CORPUS, PARTS)
_F = with_(CORPUS, PARTS, FEATS)
_R = with_(CORPUS, PARTS, FEATS, SIMILAR, REASONS)
_S = with_(CORPUS, PARTS, FEATS, SIMILAR, REASONS, SCORED_URLS, SCAN)
_U = with_(CORPUS, PARTS, FEATS, SCORED_URLS)
_L = with_(CORPUS, PARTS, FEATS, SCORED_URLS, PREDICTIONS)
_D = with_(SCORED_DOCS)

_TEXTS = "list_transform(reasons[1:5], lambda r: r.text)"

# ------------------------------------------------------------ evaluation ----


def _cells(source: str) -> str:
    return f"""SELECT CAST(count(*) FILTER (label <> 1 AND score < 0.5) AS BIGINT) AS tn, CAST(count(*) FILTER (label <> 1 AND score >= 0.5) AS BIGINT) AS fp,
       CAST(count(*) FILTER (label = 1 AND score < 0.5) AS BIGINT) AS fn, CAST(count(*) FILTER (label = 1 AND score >= 0.5) AS BIGINT) AS tp FROM {source}"""


def _metrics(prefix: str = "") -> dict[str, str]:
    tn, fp, fn, tp = (f"CAST({prefix}{c} AS DOUBLE)" for c in ("tn", "fp", "fn", "tp"))
    r = lambda num, den: f"CASE WHEN {den} > 0 THEN ({num}) / ({den}) ELSE 0.0 END"
    return {
        "accuracy": r(f"{tp} + {tn}", f"{tp} + {tn} + {fp} + {fn}"),
        "balanced_accuracy": f"({r(tp, f'{tp} + {fn}')} + {r(tn, f'{tn} + {fp}')}) / 2",
        "precision": r(tp, f"{tp} + {fp}"),
        "recall": r(tp, f"{tp} + {fn}"),
        "f1": r(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}"),
        "mcc": r(f"{tp} * {tn} - {fp} * {fn}", f"sqrt(({tp} + {fp}) * ({tp} + {fn}) * ({tn} + {fp}) * ({tn} + {fn}))"),
    }


def _steps(source: str, name: str) -> str:
    return f"""{name}_g AS (
  SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg FROM {source} GROUP BY score
), {name} AS (
  SELECT score, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
         CAST(sum(pos) OVER () AS BIGINT) AS n_pos, CAST(sum(neg) OVER () AS BIGINT) AS n_neg,
         lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg, row_number() OVER w AS place
  FROM {name}_g WINDOW w AS (ORDER BY score DESC)
)"""


_AUC = "sum(CAST(neg AS DOUBLE) * (tp - CAST(pos AS DOUBLE) / 2) / (CAST(n_pos AS DOUBLE) * n_neg))"
_AP = "sum(CAST(pos AS DOUBLE) / n_pos * tp / (tp + fp))"
_EPS = d(2.220446049250313e-16)
_ONE = d(1 - 2.220446049250313e-16)


def _points(source: str, label: str, steps: str) -> str:
    m = _metrics("c.")
    return f"""SELECT '{label}' AS data, {', '.join(f'round({e}, 6) AS {n}' for n, e in m.items())},
    round(a.roc_auc, 6) AS roc_auc, round(a.pr_auc, 6) AS pr_auc, round(b.brier, 6) AS brier, round(b.log_loss, 6) AS log_loss,
    c.tn, c.fp, c.fn, c.tp
  FROM ({_cells(source)}) c, (SELECT {_AUC} AS roc_auc, {_AP} AS pr_auc FROM {steps}) a,
    (SELECT avg(power(score - label, 2)) AS brier,
            -avg(CASE WHEN label = 1 THEN ln(least(greatest(score, {_EPS}), {_ONE})) ELSE ln(1 - least(greatest(score, {_EPS}), {_ONE})) END) AS log_loss
     FROM {source}) b"""


_GRID = f"""grid AS (
  SELECT DISTINCT t FROM (
    SELECT unnest([{', '.join(d(x) for x in GRID_STEPS)}]) AS t
    UNION ALL
    SELECT unnest(quantile_cont(score, [{', '.join(repr(x) for x in GRID_QUANTILES)}])) FROM scored_docs)
), cells AS (
  SELECT t, count(*) FILTER (label <> 1 AND score < t) AS tn, count(*) FILTER (label <> 1 AND score >= t) AS fp,
         count(*) FILTER (label = 1 AND score < t) AS fn, count(*) FILTER (label = 1 AND score >= t) AS tp
  FROM grid, scored_docs GROUP BY t
), scan AS (
  SELECT t AS threshold, {', '.join(f'{_metrics()[m]} AS "{m}"' for m in ('precision', 'recall', 'f1', 'balanced_accuracy', 'mcc'))},
         CAST(tp AS DOUBLE) / greatest(tp + fn, 1) - CAST(fp AS DOUBLE) / greatest(fp + tn, 1) AS youden_j,
         CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(10.0 * fn + 1.0 * fp AS DOUBLE) AS expected_cost
  FROM cells
)"""


def _best(criterion: str, column: str, order: str) -> str:
    return f"""SELECT * FROM (SELECT '{criterion}' AS criterion, round(threshold, 12) AS threshold, round(threshold, 4) AS threshold_shown
    FROM scan ORDER BY round({column}, 9) {order}, threshold LIMIT 1)"""


_CONFORMAL = """clipped AS (
  SELECT *, least(greatest(score, CAST(1e-9 AS DOUBLE)), 1 - CAST(1e-9 AS DOUBLE)) AS p FROM scored_docs
), strange AS (
  SELECT CASE WHEN label = 1 THEN 1 - p ELSE p END AS s FROM clipped
), ranked AS (
  SELECT s, row_number() OVER (ORDER BY s) AS k, count(*) OVER () AS n FROM strange
), fitted AS (
  SELECT s AS q, n FROM ranked WHERE k = least(greatest(CAST(ceil((n + 1) * (CAST(1.0 AS DOUBLE) - CAST(0.1 AS DOUBLE))) AS BIGINT), 1), n)
), sets AS (
  SELECT id, label, CAST(p <= q AS INTEGER) AS in0, CAST(1 - p <= q AS INTEGER) AS in1, CAST(p <= q AND 1 - p <= q AS INTEGER) AS abstain
  FROM clipped, fitted
)"""

# ----------------------------------------------------------------- drift ----


def _psi(ref: str, cur: str, columns) -> str:
    """CTEs ending in psi(feature, psi), for two relations."""
    cols = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in columns)
    names = ", ".join(f'"{c}"' for c in columns)
    probs = ", ".join(repr(i / 10) for i in range(11))
    return f"""ref_long AS (UNPIVOT (SELECT {cols} FROM {ref}) ON {names} INTO NAME feature VALUE v
), cur_long AS (UNPIVOT (SELECT {cols} FROM {cur}) ON {names} INTO NAME feature VALUE v
), raw_edges AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(v, [{probs}]))) AS e, count(*) AS n FROM ref_long GROUP BY feature
), edges AS (
  SELECT feature, n, len(e) - 1 AS bins,
         CASE WHEN len(e) < 3 THEN e ELSE list_concat(list_concat([e[1] - CAST(1e-9 AS DOUBLE)], e[2:len(e) - 1]), [e[-1] + CAST(1e-9 AS DOUBLE)]) END AS e
  FROM raw_edges
), ref_bins AS (
  SELECT feature, CASE WHEN v = e[-1] THEN bins ELSE len(list_filter(e, lambda x: x <= v)) END AS bin, count(*) AS n
  FROM ref_long JOIN edges USING (feature) WHERE v BETWEEN e[1] AND e[-1] GROUP BY ALL
), cur_bins AS (
  SELECT feature, CASE WHEN v = e[-1] THEN bins ELSE len(list_filter(e, lambda x: x <= v)) END AS bin, count(*) AS n
  FROM cur_long JOIN edges USING (feature) WHERE v BETWEEN e[1] AND e[-1] GROUP BY ALL
), ref_n AS (SELECT feature, sum(n) AS n FROM ref_bins GROUP BY feature
), cur_n AS (SELECT feature, sum(n) AS n FROM cur_bins GROUP BY feature
), cur_all AS (SELECT feature, count(*) AS n FROM cur_long GROUP BY feature
), bins AS (SELECT feature, unnest(range(1, greatest(bins, 1) + 1)) AS bin, bins, n AS ref_all FROM edges
), shares AS (
  SELECT b.feature, b.bins, b.ref_all, coalesce(a.n, 0) AS cur_all,
         greatest(coalesce(r.n, 0) / greatest(coalesce(rn.n, 0), 1), CAST(1e-6 AS DOUBLE)) AS r,
         greatest(coalesce(c.n, 0) / greatest(coalesce(cn.n, 0), 1), CAST(1e-6 AS DOUBLE)) AS c
  FROM bins b LEFT JOIN ref_bins r ON r.feature = b.feature AND r.bin = b.bin
  LEFT JOIN cur_bins c ON c.feature = b.feature AND c.bin = b.bin
  LEFT JOIN ref_n rn ON rn.feature = b.feature LEFT JOIN cur_n cn ON cn.feature = b.feature
  LEFT JOIN cur_all a ON a.feature = b.feature
), psi AS (
  SELECT feature, sum(CASE WHEN bins >= 2 AND ref_all >= 10 AND cur_all >= 10 THEN (c - r) * ln(c / r) ELSE 0.0 END) AS psi
  FROM shares GROUP BY feature
)"""


_LINES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

# -------------------------------------------------------------- mutation ----

_KEYED = f"""mutants AS (
  SELECT url_id, url, m.mutator, r.repeat, url || '|' || m.mutator || '|' || r.repeat || '|42' AS key
  FROM corpus, (SELECT unnest(['homoglyph', 'tld', 'subdomain', 'path_noise', 'percent', 'case']) AS mutator) m, (SELECT unnest([1, 2, 3, 4]) AS repeat) r WHERE label = 1
)"""


def _draw(position: str) -> str:
    return f"CAST('0x' || substr(md5(key || '|' || {position}), 1, 8) AS BIGINT)"


def _choose(values, position: str) -> str:
    return f"({lst(values)})[CAST({_draw(position)} % {len(values)} AS INTEGER) + 1]"


_CHARS = "list_transform(string_split(url, ''), lambda ch, i: {})"
_TO = "map {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in LOOKALIKE_FOR.items()) + "}"
_LETTERS = items(LOOKALIKE_FOR)
_PLACES = r"list_filter(range(1, length(url) + 1), lambda i: regexp_matches(url[i], '^\p{L}$'))"
_MUTATED = f"""SELECT url_id, mutator, CAST(repeat AS INTEGER) AS repeat, CASE mutator
  WHEN 'homoglyph' THEN array_to_string({_CHARS.format(f"CASE WHEN ch IN ({_LETTERS}) AND {_draw('(i - 1)')} < 2147483648 THEN {_TO}[ch] ELSE ch END")}, '')
  WHEN 'tld' THEN CASE WHEN regexp_matches(url, '(?i)\\.([a-z]{{2,6}})([/:?]|$)')
       THEN regexp_replace(url, '(?i)\\.([a-z]{{2,6}})([/:?]|$)', '.' || {_choose(sorted(SUSPICIOUS_TLDS), "'tld'")} || '\\2') ELSE url END
  WHEN 'subdomain' THEN regexp_replace(url, '^(\\w+://)?([^/]+)(.*)$', '\\1' || {_choose(sorted(BRANDS), "'brand'")} || '-\\2\\3')
  WHEN 'path_noise' THEN rtrim(url, '/') || '/' || array_to_string(list_transform(range(1, CAST({_draw("'length'")} % 9 + 4 AS BIGINT) + 1),
       lambda i: substr('abcdefghijklmnopqrstuvwxyz0123456789', CAST({_draw('i')} % 36 AS INTEGER) + 1, 1)), '')
  WHEN 'percent' THEN CASE WHEN len({_PLACES}) > 0 THEN (SELECT substr(url, 1, spot - 1) || '%' || printf('%X', unicode(url[spot])) || substr(url, spot + 1)
       FROM (SELECT ({_PLACES})[CAST({_draw("'place'")} % len({_PLACES}) AS INTEGER) + 1] AS spot)) ELSE url END
  ELSE array_to_string({_CHARS.format(f"CASE WHEN {_draw('(i - 1)')} < 1288490188 THEN upper(ch) ELSE ch END")}, '') END AS url
FROM mutants"""

# ----------------------------------------------------------- explanation ----


def _node(row: tuple) -> str:
    t, n, left, right, f, cut, share, weight = row
    return f"({t}, {n}, {left}, {right}, {q(f) if f else 'NULL'}, {d(cut) if f else 'NULL'}, {d(share)}, {d(weight)})"


_FOREST = f"""nodes(tree, id, lft, rgt, feature, cut, share, weight) AS (VALUES {', '.join(_node(r) for r in SMALL_FOREST)}),
walk AS (
  SELECT url_id, tree, id, CAST(NULL AS VARCHAR) AS feature, CAST(0 AS DOUBLE) AS amount FROM feats, nodes WHERE id = 0 AND error IS NULL
  UNION ALL
  SELECT w.url_id, w.tree, c.id, n.feature, (c.share - n.share) * (0.5 + 0.5 * c.weight / n.weight)
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.id = w.id AND n.lft >= 0 JOIN feats f ON f.url_id = w.url_id
  JOIN nodes c ON c.tree = n.tree AND c.id = CASE WHEN CASE n.feature {' '.join(f"WHEN '{f}' THEN f.{f}" for f in SMALL_FOREST_FEATURES)} END <= n.cut THEN n.lft ELSE n.rgt END
), moved AS (
  SELECT url_id, feature, sum(amount) / (SELECT count(DISTINCT tree) FROM nodes) AS amount FROM walk WHERE feature IS NOT NULL GROUP BY url_id, feature
)"""

# ---------------------------------------------------------------- online ----

_ON = FEATURES
_ONLINE = f"""fed AS (
  SELECT f.*, s.brand_distance, s.jaro_winkler_brand, b.true_label FROM feedback b JOIN feats f ON f.url_id = b.url_id JOIN likeness s ON s.url_id = b.url_id
), moments AS (
  SELECT count(*) AS n, {', '.join(f'avg({f}) AS m_{f}, CASE WHEN var_pop({f}) > 0 THEN sqrt(var_pop({f})) ELSE 1.0 END AS s_{f}' for f in _ON)} FROM fed
), pulls AS (
  SELECT avg(0.5 - true_label) AS b, {', '.join(f'avg((0.5 - true_label) * ({f} - m_{f}) / s_{f}) AS g_{f}' for f in _ON)} FROM fed, moments
)"""
_ONLINE_ROWS = "\nUNION ALL\n".join(
    f"""SELECT '{f}' AS feature, CAST(n AS BIGINT) AS n, round(m_{f}, 6) AS mean, round(s_{f}, 6) AS scale,
  round(sign(-0.5 * g_{f}) * greatest(abs(-0.5 * g_{f}) - {d(0.5 * 1e-4 * 0.15)}, 0), 9) AS coef, round(-0.5 * b, 6) AS intercept FROM moments, pulls"""
    for f in _ON
)

# --------------------------------------------------------------- queries ----

_PART_SIZES = f"""sizes AS (
  SELECT label, CAST(count(*) AS BIGINT) AS n, CAST(round(count(*) * {d(0.2)}) AS BIGINT) AS test FROM corpus GROUP BY label
)"""


def _upto(share: float) -> str:
    """Rows of a class in the first parts that make up so large a share."""
    return "n" if share == 1 else "0" if share == 0 else f"round(n * {d(share)})"


_TOKEN = "{{'kind': '{0}', 'text': {1}, 'weight': CAST({2} AS DOUBLE)}}"
def _label_token(l: str) -> str:
    t = _TOKEN
    return f"""CASE WHEN {l} IN ({items(BRANDS)}) THEN {t.format('brand', l, 0.7)}
      WHEN {l} = tld AND tld IN ({items(SUSPICIOUS_TLDS)}) THEN {t.format('risky_tld', l, 0.6)}
      WHEN starts_with({l}, 'xn--') THEN {t.format('punycode', l, 0.7)}
      WHEN regexp_matches({l}, '[{''.join(HOMOGLYPHS)}]') THEN {t.format('homoglyph', l, 0.8)}
      WHEN regexp_full_match({l}, '[0-9]+') THEN {t.format('digits', l, 0.3)}
      ELSE {t.format('host', l, 0.1)} END"""


def _tail_token(x: str) -> str:
    t = _TOKEN
    return f"""CASE WHEN {x} IN ('/', '?', '#', '&', '=') THEN {t.format('sep', x, 0)}
      WHEN lower({x}) IN ({items(SUSPICIOUS_WORDS)}) THEN {t.format('word', x, 0.5)}
      WHEN regexp_full_match({x}, '[0-9A-Fa-f]{{12,}}') THEN {t.format('hex', x, 0.5)}
      ELSE {t.format('path', x, 0.1)} END"""


_REST = "substr(u, length(split_part(u, '://', 1)) + 4)"
_URL_TOKENS = (
    _P
    + f"""SELECT url_id, CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS pos, unnest(toks, recursive := true) FROM (
  SELECT url_id, list_concat(list_concat([{_TOKEN.format('scheme', "split_part(u, '://', 1) || '://'", 0)}],
    flatten(list_transform(labels, lambda l, i: CASE WHEN i = 1 THEN [{_label_token('l')}] ELSE [{_TOKEN.format('sep', "'.'", 0)}, {_label_token('l')}] END))),
    list_transform(regexp_extract_all(regexp_extract({_REST}, '[/?#].*'), '[/?#&=]|[^/?#&=]+'), lambda x: {_tail_token('x')})) AS toks
  FROM parts WHERE error IS NULL)"""
)

_WATCH = " OR ".join(f"contains(lower(u_trim), {q(w.strip())})" for w in WATCH_ENTRIES if w.strip())
_RULE_VALUES = ", ".join(
    f"({q(n)}, {q(p)}, {q(s)}, {d(float(w))}, {q(k)}, {int(on)})" for n, p, s, w, k, on in _ALL_RULES
)
_RULE_COUNTS = "SELECT name, CAST(count(*) AS BIGINT) AS n_hits FROM (SELECT unnest(list_transform(rule_reasons, lambda r: r.text)) AS name FROM reasoned) GROUP BY name"

_HOST = "regexp_extract(url, '://([^/]+)', 1)"
_MANY_RULES = f"""many AS (
  SELECT DISTINCT kind, pattern FROM (SELECT unnest([
    {{'kind': 'contains', 'pattern': 'CASE=' || page_id}}, {{'kind': 'prefix', 'pattern': 'HTTPS://tinyurl.com/' || page_id}}, {{'kind': 'suffix', 'pattern': '&F=' || page_id}},
    {{'kind': 'host_equals', 'pattern': lower({_HOST})}}, {{'kind': 'tld', 'pattern': split_part(lower({_HOST}), '.', -1)}}], recursive := true) FROM pages)
)"""

ORACLE: dict[str, str] = {
    "url_corpus": with_(CORPUS) + "SELECT url_id, page_id, variant, url, label FROM corpus",
    "url_lines": "SELECT url FROM pages",
    "page_links": """SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || CASE WHEN starts_with(href, '/') THEN '' ELSE '/' END || href AS url
FROM (SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages)""",
    "parse_errors": _P + "SELECT error, CAST(count(*) AS BIGINT) AS n FROM parts GROUP BY error",
    "url_parts": _P
    + "SELECT url_id, CASE WHEN error IS NULL THEN scheme END AS scheme, CASE WHEN error IS NULL THEN host END AS host, CASE WHEN error IS NULL THEN port END AS port, CASE WHEN error IS NULL THEN path END AS path, CASE WHEN error IS NULL THEN query END AS query FROM parts",
    "url_features": with_(CORPUS, PARTS, FEATS, SIMILAR)
    + f"SELECT url_id, {', '.join(f'round({f}, 6) AS {f}' if f in DOUBLE_FEATURES else f for f in FEATURES)} FROM feats LEFT JOIN likeness USING (url_id)",
    "brand_distance": with_(CORPUS, PARTS, SIMILAR) + "SELECT url_id, brand_distance AS value FROM parts LEFT JOIN likeness USING (url_id)",
    "brand_jaro_winkler": with_(CORPUS, PARTS, SIMILAR) + "SELECT url_id, round(jaro_winkler_brand, 6) AS value FROM parts LEFT JOIN likeness USING (url_id)",
    "url_flags": _F
    + "SELECT url_id, CASE WHEN error IS NULL THEN array_to_string(brands, ',') END AS brands, CASE WHEN error IS NULL THEN array_to_string(words, ',') END AS words, CASE WHEN error IS NULL THEN CAST(shortener AS INTEGER) END AS shortener, CASE WHEN error IS NOT NULL THEN NULL WHEN scheme <> '' THEN scheme WHEN implicit THEN 'http' ELSE '(none)' END AS scheme, tld, CAST(implicit AS INTEGER) AS implicit_scheme FROM feats",
    "url_tokens": _URL_TOKENS,
    "char_entropy": f"""SELECT 'page' AS kind, page_id AS id, round({_entropy('url')}, 6) AS entropy FROM pages
UNION ALL SELECT 'doc', doc_id, round({_entropy('text')}, 6) FROM documents""",
    "shortener_semi": _P + f"SELECT url_id, host FROM parts WHERE error IS NULL AND host IN ({items(URL_SHORTENERS)})",
    "rules_table": _R
    + f"""SELECT r.name, pattern, severity, weight, kind, CAST(enabled AS INTEGER) AS enabled, CAST(coalesce(n_hits, 0) AS BIGINT) AS n_hits
FROM (VALUES {_RULE_VALUES}) AS r(name, pattern, severity, weight, kind, enabled) LEFT JOIN ({_RULE_COUNTS}) h ON h.name = 'rule: ' || r.name""",
    "rule_hits": _R + _RULE_COUNTS,
    "heuristic_reasons": _R
    + f"SELECT url_id, CAST(len(heuristic) AS INTEGER) AS n_reasons, round({_sum('heuristic')}, 6) AS reason_sum, heuristic[1].text AS top_reason, array_to_string(list_transform(heuristic, lambda r: r.severity), ',') AS severities FROM reasoned",
    "reason_sums": _R
    + f"SELECT url_id, CAST(len(reasons) AS INTEGER) AS n_reasons, round({_sum('reasons')}, 6) AS reason_sum, round(coalesce(list_sum(list_transform(rule_reasons, lambda r: r.weight)), 0.0), 6) AS rule_sum, reasons[1].text AS top_reason FROM reasoned",
    "risk_score": _R + f"SELECT url_id, CASE WHEN error IS NULL THEN {risk('0.5')} ELSE 0 END AS risk FROM reasoned",
    "top_risk": _R
    + f"SELECT url_id, url, risk, n_reasons, top_reason FROM (SELECT url_id, url, CASE WHEN error IS NULL THEN {risk('0.5')} ELSE 0 END AS risk, CAST(len(reasons) AS INTEGER) AS n_reasons, reasons[1].text AS top_reason FROM reasoned) ORDER BY risk DESC, url_id LIMIT 20",
    "top_contributions": "WITH RECURSIVE " + with_(CORPUS, PARTS, FEATS, _FOREST).removeprefix("WITH ")
    + """SELECT url_id, CAST(rank AS INTEGER) AS rank, feature, round(amount, 6) AS amount, round((SELECT avg(share) FROM nodes WHERE id = 0), 6) AS base_value
FROM (SELECT *, row_number() OVER (PARTITION BY url_id ORDER BY abs(amount) DESC, feature) AS rank FROM moved WHERE amount <> 0) WHERE rank <= 3""",
    "watchlist_joined": _P
    + f"""SELECT url_id, CAST(EXISTS (SELECT 1 FROM (SELECT DISTINCT lower(trim(e)) AS e FROM (SELECT unnest([upper({_HOST}), ' Invoice' || page_id]) AS e FROM pages)) WHERE e <> '' AND contains(lower(u_trim), e)) AS INTEGER) AS watch_hit FROM parts""",
    "rules_joined": with_(CORPUS, PARTS, FEATS, _MANY_RULES)
    + f"""SELECT url_id, unnest(list_filter([{_RULE_HITS}], lambda r: r IS NOT NULL), recursive := true) FROM feats
UNION ALL
SELECT url_id, 'rule: ' || kind || '-' || pattern AS text, 'low' AS severity, {d(0.1)} AS weight FROM feats JOIN many ON error IS NULL AND CASE kind
  WHEN 'contains' THEN contains(lower(u_trim), lower(pattern)) WHEN 'prefix' THEN starts_with(lower(u_trim), lower(pattern)) WHEN 'suffix' THEN ends_with(lower(u_trim), lower(pattern))
  WHEN 'host_equals' THEN host = pattern ELSE tld = pattern END""",
    "watchlist_override": _R
    + f"SELECT url_id, CASE WHEN {_WATCH} THEN 100 WHEN error IS NULL THEN {risk('0.5')} ELSE 0 END AS risk, CASE WHEN {_WATCH} THEN 1 ELSE 0 END AS verdict, 0 AS abstain FROM reasoned",
    "scan_linear": _S
    + """SELECT url_id, probability, verdict, risk, CASE WHEN c0 AND c1 AND error IS NULL THEN 'ABSTAIN' WHEN verdict = 1 THEN 'PHISHING' ELSE 'CLEAN' END AS label_shown,
CASE WHEN c0 AND c1 THEN 'both' WHEN c1 THEN 'phish' WHEN c0 THEN 'clean' ELSE '∅' END AS conformal_shown, CAST(len(reasons) AS INTEGER) AS n_reasons, error FROM scanned""",
    "scan_json": _S
    + "SELECT url_id, url, probability, CAST(verdict AS BIGINT) AS verdict, CAST(risk AS BIGINT) AS risk, CAST(len(reasons) AS INTEGER) AS n_reasons, CAST(url_length AS BIGINT) AS url_length, CASE WHEN error IS NULL THEN host END AS host FROM scanned",
    "distinct_score": _U + "SELECT url, CAST(3 * count(*) AS BIGINT) AS n, max(score) AS score FROM scored_urls GROUP BY url",
    "unseen_urls": _L + "SELECT DISTINCT url FROM corpus WHERE url NOT IN (SELECT url FROM predictions WHERE prediction = 1)",
    "export_csv": _S
    + """SELECT url, CASE WHEN verdict = 1 THEN 'phishing' ELSE 'clean' END AS verdict, printf('%.4f', probability) AS probability, risk,
CAST(c0 AND c1 AND error IS NULL AS INTEGER) AS abstain, CAST(c0 AS INTEGER) AS conformal_0, CAST(c1 AS INTEGER) AS conformal_1,
array_to_string(list_transform(reasons, lambda r: '[' || r.severity || '] ' || r.text), ' | ') AS reasons FROM scanned""",
    "stix_indicators": _S
    + f"""SELECT 'Phishing URL: ' || url AS name, '[url:value = ''' || replace(replace(url, '\\', '\\\\'), '''', '\\''') || ''']' AS pattern, 'malicious-activity' AS labels,
CAST(trunc(probability * 100) AS INTEGER) AS confidence, array_to_string({_TEXTS}, '; ') AS description FROM scanned WHERE verdict = 1""",
    "alerts": _S + f"SELECT url, probability, risk, verdict AS prediction, array_to_string({_TEXTS}, '; ') AS reasons FROM scanned WHERE risk >= 80",
    "audit_append": _S
    + "SELECT verdict AS prediction, 'batch' AS source, CAST(2 * count(*) AS BIGINT) AS n, CAST(2 * count(*) AS BIGINT) AS n_ids FROM scanned WHERE error IS NULL GROUP BY verdict",
    "feedback_append": with_(CORPUS, FEEDBACK) + "SELECT true_label, source, CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_prob FROM feedback GROUP BY ALL",
    "audit_recent": _L + "SELECT ts, url, prob, prediction, risk, source FROM predictions ORDER BY ts DESC, id DESC LIMIT 100",
    "recent_urls": _L + "SELECT url, max(ts) AS ts FROM predictions GROUP BY url ORDER BY ts DESC, url LIMIT 30",
    "hourly_verdicts": _L + "SELECT date_trunc('hour', ts) AS hour, prediction, CAST(count(*) AS BIGINT) AS n FROM predictions GROUP BY ALL",
    "live_counters": _L
    + "SELECT CAST(count(*) AS BIGINT) AS predictions, CAST(count(*) FILTER (prediction = 1) AS BIGINT) AS positives, CAST(count(*) FILTER (prob BETWEEN 0.35 AND 0.65) AS BIGINT) AS queue_length, CAST(0 AS BIGINT) AS online_samples, CAST(0.5 AS DOUBLE) AS threshold, 'fixed' AS model_hash FROM predictions",
    "registry_latest": "SELECT event_type AS version, 'models/' || event_id AS path, ts FROM events ORDER BY ts DESC, event_type DESC LIMIT 1",
    "registry_list": "SELECT event_type AS version, max(ts) AS ts FROM events GROUP BY event_type",
    "feedback_join": with_(CORPUS, PARTS, FEATS, FEEDBACK) + "SELECT b.url, b.true_label, f.url_length, f.dots, f.has_ip FROM feedback b JOIN feats f USING (url_id)",
    "confusion": with_(CORPUS, PARTS, FEATS, SCORED_URLS, SCORED_DOCS)
    + f"SELECT 'docs' AS data, * FROM ({_cells('scored_docs')}) UNION ALL SELECT 'urls', * FROM ({_cells('scored_urls')})",
    "point_metrics": with_(CORPUS, PARTS, FEATS, SCORED_URLS, SCORED_DOCS, _steps("scored_docs", "ds"), _steps("scored_urls", "us"))
    + _points("scored_docs", "docs", "ds") + "\nUNION ALL\n" + _points("scored_urls", "urls", "us"),
    "threshold_scan": with_(SCORED_DOCS, _GRID)
    + 'SELECT round(threshold, 12) AS threshold, round(threshold, 4) AS threshold_shown, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, round(balanced_accuracy, 6) AS balanced_accuracy, round(mcc, 6) AS mcc, round(youden_j, 6) AS youden_j, fp, fn, expected_cost FROM scan',
    "select_thresholds": with_(SCORED_DOCS, _GRID)
    + "\nUNION ALL\n".join(
        [_best("f1", "f1", "DESC"), _best("cost", "expected_cost", "ASC"), _best("youden", "youden_j", "DESC"),
         _best("balanced", "balanced_accuracy", "DESC"), _best("mcc", "mcc", "DESC")]
    ),
    "roc_curve": with_(SCORED_DOCS, _steps("scored_docs", "st"))
    + """SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr UNION ALL
SELECT round(score, 6), round(CAST(fp AS DOUBLE) / n_neg, 6), round(CAST(tp AS DOUBLE) / n_pos, 6) FROM st
WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg""",
    "roc_auc": with_(SCORED_DOCS, _steps("scored_docs", "st")) + f"SELECT round({_AUC}, 6) AS roc_auc FROM st",
    "pr_curve": with_(SCORED_DOCS, _steps("scored_docs", "st"))
    + """SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0 AS recall, 1.0 AS "precision" UNION ALL
SELECT round(score, 6), round(CAST(tp AS DOUBLE) / n_pos, 6), round(CAST(tp AS DOUBLE) / (tp + fp), 6) FROM st""",
    "avg_precision": with_(SCORED_DOCS, _steps("scored_docs", "st")) + f"SELECT round({_AP}, 6) AS avg_precision FROM st",
    "calibration_curve": with_(SCORED_DOCS)
    + f"""SELECT CAST(len(list_filter(e, lambda x: x < score)) AS INTEGER) AS bin, round(avg(score), 6) AS mean_score, round(avg(label), 6) AS frac_pos, CAST(count(*) AS BIGINT) AS n
FROM scored_docs, (SELECT quantile_cont(score, [{', '.join(repr(i / 12) for i in range(1, 12))}]) AS e FROM scored_docs) GROUP BY 1""",
    "conformal_fit": with_(SCORED_DOCS, _CONFORMAL) + "SELECT round(q, 6) AS q, CAST(n AS BIGINT) AS n FROM fitted",
    "conformal_sets": with_(SCORED_DOCS, _CONFORMAL) + "SELECT id, in0, in1, abstain FROM sets",
    "conformal_coverage": with_(SCORED_DOCS, _CONFORMAL)
    + "SELECT round(avg(CASE WHEN label = 1 THEN in1 ELSE in0 END), 6) AS coverage, round(avg(in0 + in1), 6) AS size FROM sets",
    "dataset_counts": with_(CORPUS) + "SELECT label, CAST(count(*) AS BIGINT) AS n FROM corpus GROUP BY label",
    # the sizes of the parts are determined; which rows are in them is up to the hash
    "stratified_split": with_(CORPUS, _PART_SIZES)
    + "SELECT label, 'test' AS part, test AS n FROM sizes UNION ALL SELECT label, 'train', n - test FROM sizes",
    "stratified_folds": with_(CORPUS, _PART_SIZES)
    + "\nUNION ALL\n".join(
        f"SELECT label, CAST({k} AS INTEGER) AS fold, CAST({_upto(sum([0.2] * (k + 1)) if k < 4 else 1)} - {_upto(sum([0.2] * k))} AS BIGINT) AS n FROM sizes" for k in range(5)
    ),
    "half_split": with_(CORPUS, _PART_SIZES)
    + "SELECT label, 'calibrate' AS half, CAST(round(test * CAST(0.5 AS DOUBLE)) AS BIGINT) AS n FROM sizes "
    "UNION ALL SELECT label, 'evaluate', test - CAST(round(test * CAST(0.5 AS DOUBLE)) AS BIGINT) FROM sizes",
    "active_queue": _D
    + "SELECT id, round(1 - abs(score - 0.5) * 2, 6) AS uncertainty, score FROM scored_docs WHERE score BETWEEN 0.35 AND 0.65 ORDER BY 1.0 - abs(score - CAST(0.5 AS DOUBLE)) * 2.0 DESC, id LIMIT 20",
    "psi_drift": "WITH " + _psi("(SELECT * FROM lineitem WHERE l_returnflag = 'N')", "(SELECT * FROM lineitem WHERE l_returnflag <> 'N')", _LINES)
    + " SELECT feature, round(psi, 6) AS psi FROM psi",
    "drift_report": with_(CORPUS, PARTS, FEATS, SIMILAR).rstrip() + ",\n"
    + _psi("(SELECT * FROM feats JOIN likeness USING (url_id) WHERE variant = 0)", "(SELECT * FROM feats JOIN likeness USING (url_id))", CONTINUOUS_FEATURES)
    + """, both_ AS (SELECT feature, psi FROM psi UNION ALL SELECT '_max_psi', max(psi) FROM psi)
SELECT feature, round(psi, 6) AS psi, CASE WHEN psi >= 0.25 THEN 'ALERT' WHEN psi >= 0.1 THEN 'warn' ELSE 'ok' END AS status FROM both_""",
    "ngram_counts": """WITH words AS (SELECT ' ' || unnest(list_filter(regexp_split_to_array(lower(url), '\\s+'), lambda x: x <> '')) || ' ' AS w FROM pages)
SELECT gram, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unnest(flatten(list_transform([2, 3, 4], lambda n: list_transform(range(1, length(w) - n + 2), lambda i: substr(w, i, n))))) AS gram FROM words) GROUP BY gram""",
    "scaled_features": with_(CORPUS, PARTS, FEATS, SIMILAR)
    + "\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, round(avg({f}), 6) AS mean, round(stddev_pop({f}), 6) AS std FROM feats JOIN likeness USING (url_id)" for f in CONTINUOUS_FEATURES
    ),
    "mutated_urls": with_(CORPUS, _KEYED) + _MUTATED,
    "online_update": with_(CORPUS, PARTS, FEATS, SIMILAR, FEEDBACK, _ONLINE) + _ONLINE_ROWS,
    "watch_scan": _S
    + f"""SELECT DISTINCT u_trim AS url, probability, CASE WHEN {_WATCH} THEN 1 ELSE verdict END AS verdict, CASE WHEN {_WATCH} THEN 100 ELSE risk END AS risk,
CAST(len(reasons) + CASE WHEN {_WATCH} THEN 1 ELSE 0 END AS INTEGER) AS n_reasons FROM scanned WHERE error IS NULL""",
}
