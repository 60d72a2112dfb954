"""Reasons for a score: built-in heuristics, user rules and the watchlist."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import PySparkException

from linksift.constants import DEFAULT_RULES, RULE_DEFAULTS
from linksift.functions.text import contains_any, strip
from linksift.operators.containment import containing
from linksift.session import written

REASON_TYPE = "struct<text:string,severity:string,weight:double,source:string>"
RULES_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("pattern", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("weight", T.DoubleType()),
        T.StructField("kind", T.StringType()),
        T.StructField("enabled", T.BooleanType()),
    ]
)
# Rules and watch entries become literals of one projection, this many per array.
LITERALS_PER_STEP = 200
#: Watch entries and rules up to which they are constants of the plan; more of them are joined.
MOST_LITERALS = 1_000


def reason(text: Column | str, severity: str, weight: float, source: str = "heuristic") -> Column:
    text = F.lit(text) if isinstance(text, str) else text
    return F.struct(
        text.alias("text"),
        F.lit(severity).alias("severity"),
        F.lit(float(weight)).alias("weight"),
        F.lit(source).alias("source"),
    )


def heuristic_reasons() -> Column:
    """The built-in reasons that hold for a row, in fixed order; one ``info`` reason if none does."""
    c, flag = F.col, lambda name: F.col("flags")[name]

    def counted(before: str, name: str, after: str) -> Column:
        return F.concat(F.lit(before), c(name).cast("string"), F.lit(after))

    brands, words = flag("brands"), flag("suspicious_words")
    named_brands = F.when(
        F.size(brands) > 0, F.concat(F.lit(": "), F.array_join(F.slice(brands, 1, 3), ", "))
    ).otherwise("")
    # Condition, text, severity, weight.
    table = [
        (c("has_at") == 1, "url contains '@' — real host is masked", "high", 0.9),
        (c("has_ip") == 1, "host is an IP address, not a domain", "high", 0.9),
        (c("suspicious_tld") == 1, F.concat(F.lit("TLD ."), flag("tld"), F.lit(" — dodgy zone")), "medium", 0.6),
        (c("punycode") == 1, "punycode (xn--) — possible homograph attack", "high", 0.7),
        (c("homoglyph") == 1, "contains look-alike characters (homoglyphs)", "high", 0.8),
        (c("double_slash") == 1, "url contains '//' — redirect pattern", "low", 0.4),
        (c("hex_encoding") == 1, "contains hex-encoded characters (%XX)", "medium", 0.5),
        (c("subdomains") >= 3, counted("many subdomains (", "subdomains", ")"), "low", 0.3),
        (c("url_length") >= 90, counted("url too long (", "url_length", " chars)"), "low", 0.3),
        (
            c("brand_in_subdomain") == 1,
            F.concat(F.lit("brand in subdomain — likely imitation"), named_brands),
            "high",
            0.8,
        ),
        (c("url_entropy") >= 4.3, "high entropy — looks like a random string", "low", 0.3),
        (c("https") == 0, "no HTTPS", "medium", 0.4),
        (flag("shortener"), F.concat(F.lit("url shortener ("), flag("host"), F.lit(")")), "medium", 0.5),
        (
            c("port") == 1,
            F.concat(F.lit("non-standard port ("), flag("port").cast("string"), F.lit(")")),
            "medium",
            0.5,
        ),
        (
            F.size(words) > 0,
            F.concat(F.lit("data-theft keywords: "), F.array_join(F.slice(words, 1, 4), ", ")),
            "medium",
            0.4,
        ),
        (c("path_depth") >= 6, counted("deep path (", "path_depth", " segments)"), "low", 0.2),
        (c("params") >= 6, counted("many query parameters (", "params", ")"), "low", 0.2),
        (c("double_extension") == 1, "double extension (e.g. .pdf.html) — evasion", "high", 0.8),
        (c("encoded_redirect") == 1, "contains encoded redirect", "medium", 0.5),
        (c("max_digit_run") >= 6, counted("long digit run (", "max_digit_run", ")"), "low", 0.3),
        (
            (c("brand_distance") <= 1) & (c("brand_in_subdomain") == 0),
            "domain almost like a brand — typosquatting",
            "high",
            0.85,
        ),
        (
            (c("jaro_winkler_brand") >= 0.9) & (c("brand_distance") > 1),
            "very similar to a brand (Jaro-Winkler ≥ 0.9)",
            "high",
            0.75,
        ),
        (c("ip_in_hex") == 1, "IP address in hex format (0x...)", "high", 0.7),
        (c("too_many_dots") == 1, "too many dots in url", "low", 0.3),
        (c("ends_with_zip") == 1, "url ends with .zip — possible file lure", "medium", 0.5),
        (c("exclamation_marks") >= 3, "many exclamation marks — pressure on user", "low", 0.25),
    ]
    hits = F.array_compact(F.array(*[F.when(test, reason(text, sev, w)) for test, text, sev, w in table]))
    nothing = F.array(reason("nothing suspicious found", "info", 0.0))
    return F.when(F.size(hits) > 0, hits).otherwise(nothing)


def with_heuristics(df: DataFrame) -> DataFrame:
    """Add ``heuristic_reasons``; error rows get one reason that names the error."""
    failed = F.array(reason(F.concat(F.lit("could not parse: "), F.col("error")), "high", 1.0))
    return df.withColumn("heuristic_reasons", F.when(F.col("error").isNull(), heuristic_reasons()).otherwise(failed))


# ---------------------------------------------------------------- rules ----


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*r, True) for r in DEFAULT_RULES], RULES_SCHEMA)


def _java_pattern(pattern: str) -> str:
    """Named groups, back-references and end anchors in the spelling Java reads."""
    pattern = re.sub(r"\(\?P<(\w+)>", r"(?<\1>", pattern)
    pattern = re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern)
    return pattern.replace(r"\Z", r"\z")


def _java_accepts(spark: SparkSession, patterns: list[str]) -> bool:
    """True if Spark can compile all patterns. They fold to constants while planning: no job runs."""
    args = {f"p{i}": "(?iUd)" + _java_pattern(p) for i, p in enumerate(patterns)}
    try:
        spark.sql("SELECT array(" + ", ".join(f"rlike('', :{name})" for name in args) + ")", args=args).collect()
    except PySparkException:
        return False
    return True


def usable_patterns(spark: SparkSession, patterns: list[str]) -> set[str]:
    """The patterns that both dialects accept; a broken one never hits."""
    sound = []
    for p in dict.fromkeys(patterns):
        try:
            re.compile(p)
            sound.append(p)
        except re.error:
            continue
    if _java_accepts(spark, sound):
        return set(sound)
    return {p for p in sound if _java_accepts(spark, [p])}


def _rule_hit(kind: str, pattern: str) -> Column | None:
    raw, lowered = F.col("u_trim"), F.lower(F.col("u_trim"))
    if kind == "contains":
        return lowered.contains(pattern.lower())
    if kind == "prefix":
        return lowered.startswith(pattern.lower())
    if kind == "suffix":
        return lowered.endswith(pattern.lower())
    if kind == "host_equals":
        return F.col("u_host") == pattern
    if kind == "tld":
        return F.col("u_tld") == pattern
    if kind == "regex":
        return raw.rlike("(?iUd)" + _java_pattern(pattern))
    return None


def apply_rules(df: DataFrame, rules: DataFrame, most_literals: int = MOST_LITERALS) -> DataFrame:
    """Add ``rule_reasons``: a reason per enabled rule that hits, in rule order.

    The frame needs the part columns. Rules are settings of a job: up to ``most_literals``
    of them become constants of a projection over the URLs, without a join; a long rule set is
    laid out over several projections. Beyond that, only regular expressions (they must be
    constants to be compiled once) stay in the plan; the other kinds are joined with the URLs.
    Streams always take constants.
    """
    rules = rules.select(RULES_SCHEMA.fieldNames()).filter("enabled")
    rows = (rules if df.isStreaming else rules.limit(most_literals + 1)).collect()
    if len(rows) > most_literals and not df.isStreaming:
        return _joined_rules(df, rules)
    hits = [hit for _, hit in _literal_hits(df.sparkSession, rows)]
    return _laid_out(df, "rule_reasons", hits, REASON_TYPE)


def _literal_hits(spark: SparkSession, rows: list) -> list[tuple]:
    """(row, reason or NULL) for every rule whose kind and pattern can hit."""
    usable = usable_patterns(spark, [r.pattern for r in rows if r.kind == "regex"])
    hits = []
    for r in rows:
        if r.kind == "regex" and r.pattern not in usable:
            continue
        test = _rule_hit(r.kind, r.pattern)
        if test is not None:
            hits.append((r, F.when(test, reason(f"rule: {r.name}", r.severity, r.weight, "rule"))))
    return hits


def _laid_out(df: DataFrame, name: str, hits: list[Column], kind: str) -> DataFrame:
    """Add the array of those hits that are not NULL; error rows have none."""
    out = df.withColumn(name, F.array().cast(f"array<{kind}>"))
    for i in range(0, len(hits), LITERALS_PER_STEP):
        found = F.concat(name, F.array_compact(F.array(*hits[i : i + LITERALS_PER_STEP])))
        out = out.withColumn(name, F.when(F.col("error").isNull(), found).otherwise(F.col(name)))
    return out


def _joined_rules(df: DataFrame, rules: DataFrame) -> DataFrame:
    """The same reasons by joins: hosts and top-level domains by key, parts of URLs by rare grams.

    Each distinct URL meets its rules once. Rules keep their order by a number that is
    written with them.
    """
    numbered = written(rules.withColumn("no", F.monotonically_increasing_id()), "rules")
    text = F.concat(F.lit("rule: "), F.col("name"))
    why = F.struct(text.alias("text"), "severity", "weight", F.lit("rule").alias("source"))
    # an empty pattern is part of every URL and has no gram: such rules stay constants, like regular expressions
    constant = (F.col("kind") == "regex") | (F.col("pattern") == "")
    reasons = numbered.filter(~constant).select(F.col("no").alias("entry_id"), "kind", "pattern", why.alias("why"))
    urls = df.filter("error IS NULL").select("u_trim", "u_host", "u_tld").distinct()
    urls = written(urls, "rule-urls")

    low = F.lower("pattern")
    parts = reasons.filter(F.col("kind").isin("contains", "prefix", "suffix"))
    found = containing(urls.select(F.lower("u_trim").alias("text")), parts.select("entry_id", low.alias("needle")))
    told = found.join(parts.select("entry_id", "kind", low.alias("needle"), "why"), "entry_id")
    fits = (
        F.when(F.col("kind") == "prefix", F.col("text").startswith(F.col("needle")))
        .when(F.col("kind") == "suffix", F.col("text").endswith(F.col("needle")))
        .otherwise(True)
    )
    told = told.filter(fits).select("text", "entry_id", "why")
    hits = urls.withColumn("text", F.lower("u_trim")).join(told, "text").select("u_trim", "entry_id", "why")
    for kind, column in (("host_equals", "u_host"), ("tld", "u_tld")):
        keyed = reasons.filter(F.col("kind") == kind).select(F.col("pattern").alias(column), "entry_id", "why")
        hits = hits.unionByName(urls.join(keyed, column).select("u_trim", "entry_id", "why"))
    per_url = hits.groupBy("u_trim").agg(F.collect_list(F.struct("entry_id", "why")).alias("_joined"))

    kept = numbered.filter(constant).orderBy("no").collect()
    numbers = [
        F.when(hit.isNotNull(), F.struct(F.lit(r.no).alias("entry_id"), hit.alias("why")))
        for r, hit in _literal_hits(df.sparkSession, kept)
    ]
    kind = f"struct<entry_id:bigint,why:{REASON_TYPE}>"
    out = _laid_out(df, "_matched", numbers, kind).join(per_url, "u_trim", "left")
    none = F.array().cast(f"array<{kind}>")
    whole = F.concat("_matched", F.coalesce("_joined", none))
    in_order = F.transform(F.array_sort(whole, lambda a, b: F.signum(a["entry_id"] - b["entry_id"]).cast("int")), lambda h: h["why"])
    given = F.when(F.col("error").isNull(), in_order).otherwise(F.array().cast(f"array<{REASON_TYPE}>"))
    return out.withColumn("rule_reasons", given).select(*df.columns, "rule_reasons")


# ------------------------------------------------------------ watchlist ----


def apply_watchlist(
    df: DataFrame, watchlist: DataFrame, url_col: str = "url", urls: DataFrame | None = None, most_literals: int = MOST_LITERALS
) -> DataFrame:
    """Add ``watch_hit``: some non-empty entry is part of the lower-cased URL.

    Up to ``most_literals`` entries are constants of the plan. More of them are joined with the
    distinct URLs by rare grams; ``urls`` may name a frame that holds the same URLs and is
    cheaper to read than ``df``. Streams always take constants.
    """
    entries = watchlist.select(F.lower(strip(F.col("entry"))).alias("needle")).filter("needle <> ''").distinct()
    url = F.lower(strip(F.coalesce(F.col(url_col), F.lit(""))))
    rows = (entries if df.isStreaming else entries.limit(most_literals + 1)).collect()
    if len(rows) > most_literals and not df.isStreaming:
        texts = (df if urls is None else urls).select(url.alias("text"))
        hits = containing(texts, entries.withColumn("entry_id", F.xxhash64("needle")))
        hits = written(hits.select(F.col("text").alias("_watched")).distinct().withColumn("watch_hit", F.lit(True)), "watch-hits")
        out = df.drop("watch_hit").withColumn("_watched", url).join(hits, "_watched", "left").drop("_watched")
        return out.withColumn("watch_hit", F.coalesce("watch_hit", F.lit(False)))
    out = df.withColumn("watch_hit", F.lit(False))
    needles = sorted(r[0] for r in rows)
    for i in range(0, len(needles), LITERALS_PER_STEP):
        out = out.withColumn("watch_hit", F.col("watch_hit") | contains_any(url, needles[i : i + LITERALS_PER_STEP]))
    return out


def watch_reason() -> Column:
    return reason("watchlist match", "critical", 1.0, "rule")


def reason_sum(reasons: Column) -> Column:
    """Sum of the weights, without ``info`` reasons."""
    return F.aggregate(
        reasons,
        F.lit(0.0),
        lambda acc, r: acc + F.when(r["severity"] == "info", 0.0).otherwise(r["weight"]),
    )


def weight_sum(reasons: Column) -> Column:
    """Sum of all weights, those of ``info`` reasons too."""
    return F.aggregate(reasons, F.lit(0.0), lambda acc, r: acc + r["weight"])


def rules_with_defaults(rows: DataFrame) -> DataFrame:
    """Fill the fields that a rules file may leave out."""
    have = set(rows.columns)

    def field(name: str, kind: str) -> Column:
        given = F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)
        return F.coalesce(given, F.lit(RULE_DEFAULTS[name])).alias(name)

    return rows.select(
        F.col("name").cast("string").alias("name"),
        F.col("pattern").cast("string").alias("pattern"),
        field("severity", "string"),
        field("weight", "double"),
        field("kind", "string"),
        field("enabled", "boolean"),
    )
