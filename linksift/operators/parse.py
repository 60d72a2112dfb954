"""URL text -> parts, 50 lexical features, flags and tokens.

Everything here is a projection: no shuffle, no join. The work is laid out as a
few projections on top of each other, so that shared values (the parts) are
worked out once and later stages refer to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linksift.constants import (
    BRANDS,
    DOUBLE_EXTENSION_PATTERN,
    DOUBLE_FEATURES,
    FEATURES,
    HEX_IP_PATTERN,
    HEX_SEQUENCE_PATTERN,
    HEX_TOKEN_PATTERN,
    HOMOGLYPHS,
    MAX_URL_CHARS,
    REDIRECT_KEY_PATTERN,
    RISKY_SCHEMES,
    SUSPICIOUS_WORDS,
    TOKEN_SEPARATOR_PATTERN,
    TOKEN_WEIGHTS,
    URL_SHORTENERS,
)
from linksift.functions import urlparts as parts
from linksift.functions.similarity import brand_distance, brand_likeness
from linksift.functions.stages import staged
from linksift.functions.text import (
    DIGIT_CLASS,
    contained,
    contains_any,
    count_of,
    entropy,
    is_ascii,
    normalise,
    punycode_decoded,
    strip,
    without_blanks,
)

PART_COLUMNS = (
    "u_trim", "u_full", "u_implicit", "u_scheme", "u_host", "u_port", "u_path",
    "u_query", "u_labels", "u_tld",
)
SIMILARITY_FEATURES = ("brand_distance", "jaro_winkler_brand")
_HOMOGLYPH_CLASS = "[" + "".join(HOMOGLYPHS) + "]"


def with_url_parts(df: DataFrame, url_col: str = "url", reject_nul: bool = False) -> DataFrame:
    """Add ``error`` and the part columns (``u_*``). Parts are NULL in error rows.

    ``reject_nul`` also refuses text holding a NUL character (request checking).
    """
    keep = [c for c in df.columns if c not in (*PART_COLUMNS, "error")]
    raw = F.col(url_col)
    trimmed = df.select(*keep, strip(F.coalesce(raw, F.lit(""))).alias("u_trim"))
    normal = trimmed.select(*keep, "u_trim", normalise(F.col("u_trim")).alias("_normal"))
    cleaned = staged(normal, [*keep, "u_trim"], _text=F.col("_normal"))

    text = F.col("_text")
    refuse = F.when(F.col("u_trim") == "", "empty url").when(
        F.length(text) > MAX_URL_CHARS, f"url too long (max {MAX_URL_CHARS})"
    )
    if reject_nul:
        refuse = F.when(F.col("u_trim").contains("\0"), "url holds a NUL character").otherwise(refuse)
    checked = cleaned.select(*keep, "u_trim", "_text", refuse.alias("_refused"))

    usable = F.when(F.col("_refused").isNull(), text)
    full = F.when(text.contains("://"), usable).otherwise(F.concat(F.lit("http://"), usable))
    whole = checked.select(
        *keep,
        "u_trim",
        "_refused",
        F.when(F.col("_refused").isNull(), ~text.contains("://")).alias("u_implicit"),
        full.alias("u_full"),
    )
    cut = whole.select(*keep, "u_trim", "_refused", "u_implicit", "u_full", parts.searchable(F.col("u_full")).alias("_s"))
    fronts = cut.select(
        *keep, "u_trim", "_refused", "u_implicit", "u_full",
        parts.before_fragment_and_query(F.col("_s")).alias("_front"),
        parts.query_of(F.col("_s")).alias("_query"),
    )
    schemed = fronts.select("*", parts.scheme_of(F.col("_front")).alias("_scheme"))
    rested = schemed.select("*", parts.after_scheme(F.col("_front"), F.col("_scheme")).alias("_rest"))
    located = rested.select("*", parts.netloc_of(F.col("_rest")).alias("_netloc"))
    judged = staged(located, _bad_host=parts.host_error(F.col("_netloc")))

    ok = F.col("_bad_host").isNull()
    split = judged.select(
        *keep,
        F.coalesce(
            F.col("_refused"), F.concat(F.lit("could not parse url: "), F.col("_bad_host"))
        ).alias("error"),
        "u_trim",
        F.when(ok, F.col("u_full")).alias("u_full"),
        F.when(ok, F.col("u_implicit")).alias("u_implicit"),
        F.when(ok, F.col("_scheme")).alias("u_scheme"),
        F.when(ok, parts.host_of(F.col("_netloc"))).alias("u_host"),
        F.when(ok, parts.port_of(F.col("_netloc"))).alias("u_port"),
        F.when(
            ok, parts.path_of(parts.raw_path_of(F.col("_rest"), F.col("_netloc")), F.col("_scheme"))
        ).alias("u_path"),
        F.when(ok, F.col("_query")).alias("u_query"),
    )
    labelled = split.select("*", parts.labels_of(F.col("u_host")).alias("u_labels"))
    return labelled.select("*", parts.tld_of(F.col("u_labels")).alias("u_tld"))


def decoded_keys(query: Column) -> Column:
    """All keys of a query string, percent-decoded and joined.

    A '%' that starts no escape is first written as '%25', so that the decoder
    leaves it in place instead of refusing the whole key.
    """
    fields = without_blanks(F.split(F.regexp_replace(query, "%(?![0-9A-Fa-f]{2})", "%25"), "&"))
    return F.array_join(F.transform(fields, lambda f: F.try_url_decode(F.substring_index(f, "=", 1))), "")


def feature_columns() -> dict[str, Column]:
    """The features that need nothing but the part columns and ``_*`` helpers of the same row."""
    full, host, path, query = (F.col(c) for c in ("u_full", "u_host", "u_path", "u_query"))
    labels, tld, scheme, port = (F.col(c) for c in ("u_labels", "u_tld", "u_scheme", "u_port"))
    n, digits, hyphens, dots = (F.col(c) for c in ("_n", "_digits", "_hyphens", "_dots"))
    tokens, sub = F.col("_path_tokens"), F.col("_sub")
    suspicious = parts.is_suspicious_tld(tld)
    blob = r"(?<![\p{L}\p{N}_])[0-9A-Fa-f]{16,}(?![\p{L}\p{N}_])"
    return {
        "url_length": F.greatest(F.lit(1), n),
        "dots": dots,
        "hyphens": hyphens,
        "digits": digits,
        "slashes": count_of(full, "/"),
        "question_marks": count_of(full, "?"),
        "equals_signs": count_of(full, "="),
        "ampersands": count_of(full, "&"),
        "percents": count_of(full, "%"),
        "path_length": F.length(path),
        "query_length": F.length(query),
        "has_at": full.contains("@"),
        "has_ip": host.rlike(parts.IPV4_PATTERN),
        "double_slash": path.contains("//") | query.contains("//"),
        "punycode": host.startswith("xn--") | host.contains(".xn--"),
        "hex_encoding": full.rlike(HEX_SEQUENCE_PATTERN) | full.rlike(blob),
        "subdomains": F.greatest(F.lit(0), F.size(labels) - 2),
        "domain_length": F.length(host),
        "suspicious_tld": suspicious,
        "digit_ratio": digits / F.greatest(F.lit(1), n),
        "hyphen_ratio": hyphens / F.greatest(F.lit(1), n),
        "https": scheme == "https",
        "ssl_hint": (scheme == "https") & ~suspicious,
        "brand_in_subdomain": contains_any(sub, BRANDS)
        | ((F.size(labels) >= 2) & (hyphens > 0) & contains_any(F.col("_last_two"), BRANDS)),
        "url_entropy": entropy(full),
        "params": F.size(without_blanks(F.split(query, "&"))),
        "max_token": F.coalesce(F.array_max(F.transform(tokens, F.length)), F.lit(0)),
        "tld_length": F.length(tld),
        "port": F.coalesce(~port.isin(80, 443), F.lit(False)),
        "path_depth": F.size(without_blanks(F.split(path, "/"))),
        "homoglyph": ~is_ascii(full) & full.rlike(_HOMOGLYPH_CLASS),
        "unicode_mix": F.when(is_ascii(full), F.lit(0.0)).otherwise(
            F.length(F.regexp_replace(full, r"[\x00-\x7F]+", "")) / n
        ),
        "scheme_risk": F.when(scheme == "https", 0.0).when(scheme.isin(*RISKY_SCHEMES), 1.0).otherwise(0.5),
        "double_extension": path.rlike("(?id)" + DOUBLE_EXTENSION_PATTERN),
        "key_entropy": F.when(query == "", F.lit(0.0)).otherwise(entropy(F.col("_keys"))),
        "path_tokens": F.size(tokens),
        "authority_length": F.length(host) + F.when(port > 0, 6).otherwise(0),
        "encoded_redirect": query.rlike("(?iU)" + REDIRECT_KEY_PATTERN) | full.rlike("(?i)%2f%2f"),
        "max_digit_run": F.coalesce(
            F.array_max(F.transform(F.regexp_extract_all(full, F.lit(r"\p{Nd}+"), F.lit(0)), F.length)), F.lit(0)
        ),
        "subdomain_entropy": entropy(sub),
        "path_entropy": entropy(path),
        "query_entropy": entropy(query),
        "ip_in_hex": full.rlike("(?i)" + HEX_IP_PATTERN),
        "contains_port_8080": F.coalesce(port == 8080, F.lit(False)),
        "too_many_dots": dots >= 5,
        "ends_with_zip": F.lower(path).endswith(".zip"),
        "exclamation_marks": count_of(full, "!"),
        "consecutive_question_marks": full.contains("??"),
    }


def flags_column() -> Column:
    """The descriptive struct next to the numeric features."""
    scheme = F.col("u_scheme")
    haystack = F.concat_ws("\n", F.lower(F.col("u_path")), F.lower(F.col("u_query")))
    return F.struct(
        F.when(scheme != "", scheme)
        .otherwise(F.when(F.col("u_implicit"), F.lit("http")).otherwise(F.lit("(none)")))
        .alias("scheme"),
        F.col("u_implicit").alias("implicit_scheme"),
        F.col("u_host").alias("host"),
        F.col("u_port").alias("port"),
        F.col("u_tld").alias("tld"),
        F.col("u_host").rlike(parts.IPV4_PATTERN).alias("ip_host"),
        F.col("u_host").isin(*URL_SHORTENERS).alias("shortener"),
        contained(F.lower(F.col("u_full")), BRANDS).alias("brands"),
        contained(haystack, SUSPICIOUS_WORDS).alias("suspicious_words"),
        F.col("u_path").alias("path"),
        F.col("u_query").alias("query"),
        punycode_decoded(F.col("u_host")).alias("punycode_decoded"),
    )


def with_url_features(
    df: DataFrame,
    url_col: str = "url",
    similarity: bool = True,
    flags: bool = True,
    keep_parts: bool = False,
    reject_nul: bool = False,
) -> DataFrame:
    """Add ``error``, the feature columns, ``flags`` and, on request, the part columns.

    ``similarity=False`` leaves out the two brand features. Entropies and brand likeness
    are the steps over Arrow that ASCII rows need.
    """
    names = [f for f in FEATURES if similarity or f not in SIMILARITY_FEATURES]
    own = [c for c in df.columns if c not in FEATURES and c not in (*PART_COLUMNS, "error", "flags")]
    split = with_url_parts(df.select(*own), url_col, reject_nul)

    full, labels, query = F.col("u_full"), F.col("u_labels"), F.col("u_query")
    helpers = split.select(
        "*",
        F.length(full).alias("_n"),
        F.length(F.regexp_replace(full, f"[^{DIGIT_CLASS}]+", "")).alias("_digits"),
        count_of(full, "-").alias("_hyphens"),
        count_of(full, ".").alias("_dots"),
        without_blanks(F.split(F.col("u_path"), TOKEN_SEPARATOR_PATTERN)).alias("_path_tokens"),
        F.array_join(F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 2, F.lit(0))), ".").alias("_sub"),
        # joined here, once: it is searched for each brand
        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "-").alias("_last_two"),
        decoded_keys(query).alias("_keys"),
    )
    columns = feature_columns()
    if similarity:
        columns["brand_distance"] = brand_distance(labels)
        columns["jaro_winkler_brand"] = brand_likeness(F.col("u_host"))
    valid = F.col("error").isNull()
    chosen = {f: F.when(valid, columns[f].cast("double" if f in DOUBLE_FEATURES else "int")) for f in names}
    if flags:
        chosen["flags"] = F.when(valid, flags_column())
    return staged(helpers, [*own, "error", *(PART_COLUMNS if keep_parts else ())], **chosen)


def require_features(df: DataFrame) -> DataFrame:
    """Refuse, when the plan is built, a frame that lacks one of the 50 features."""
    missing = sorted(set(FEATURES) - set(df.columns))
    if missing:
        raise ValueError(f"feature schema mismatch, missing: {missing}")
    return df


def _token(kind: str | Column, text: Column, weight: Column | None = None) -> Column:
    if isinstance(kind, str):
        kind, weight = F.lit(kind), F.lit(TOKEN_WEIGHTS[kind])
    return F.struct(kind.alias("kind"), text.alias("text"), weight.alias("weight"))


def _first_kind(text: Column, cases: list[tuple[Column, str]], default: str) -> Column:
    kind, weight = F, F
    for test, name in cases:
        kind = kind.when(test, name)
        weight = weight.when(test, TOKEN_WEIGHTS[name])
    return _token(kind.otherwise(default), text, weight.otherwise(TOKEN_WEIGHTS[default]))


def tokens_column() -> Column:
    """ARRAY<STRUCT<kind, text, weight>> of scheme, host labels and the pieces of the tail."""
    full, labels, tld = F.col("u_full"), F.col("u_labels"), F.col("u_tld")
    scheme = F.concat(F.substring_index(full, "://", 1), F.lit("://"))
    rest = F.substring(full, F.length(scheme) + 1, F.length(full))
    tail = F.regexp_extract(rest, r"(?s)[/?#].*", 0)
    dot = _token("sep", F.lit("."))

    def label_tokens(label: Column, i: Column) -> Column:
        token = _first_kind(
            label,
            [
                (label.isin(*BRANDS), "brand"),
                ((label == tld) & parts.is_suspicious_tld(tld), "risky_tld"),
                (label.startswith("xn--"), "punycode"),
                (label.rlike(_HOMOGLYPH_CLASS), "homoglyph"),
                (parts.is_digits(label), "digits"),
            ],
            "host",
        )
        return F.when(i == 0, F.array(token)).otherwise(F.array(dot, token))

    def tail_token(piece: Column) -> Column:
        return _first_kind(
            piece,
            [
                (piece.isin(*"/?#&="), "sep"),
                (F.lower(piece).isin(*SUSPICIOUS_WORDS), "word"),
                (piece.rlike(rf"^{HEX_TOKEN_PATTERN}\z"), "hex"),
            ],
            "path",
        )

    return F.concat(
        F.array(_token("scheme", scheme)),
        F.flatten(F.transform(labels, label_tokens)),
        F.transform(F.regexp_extract_all(tail, F.lit("[/?#&=]|[^/?#&=]+"), F.lit(0)), tail_token),
    )


def with_tokens(df: DataFrame) -> DataFrame:
    """Add ``tokens`` to a frame that has the part columns."""
    return df.withColumn("tokens", F.when(F.col("error").isNull(), tokens_column()))
