"""URL filter: stated rules first, then a tree of path templates with labelled purity.

Per host, and once over all hosts, typed paths are arranged in a tree. A branch of the
tree stays literal where it has support and its share of blocked pages differs from
its siblings' by a two-proportion test; all other branches of a node, i.e. variable
segments and branches that behave alike, are merged into one wildcard. A template's
purity is its share of blocked pages, shrunk towards the template of the tree over all
hosts, and that towards the overall share. Pages without a rule go by the purity.

The tree has as many levels as the paths. Only branches that hold blocked and allowed pages
are followed down: below one of a single kind no share can differ, so all that is left of
its paths are wildcards. Literal ``*`` and ``{`` in a path are escaped as %2A and %7B.

Every expression below is SQL text that Spark and DuckDB read alike, so the same
definitions serve ``filter_urls`` and ``oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linksift.llm.common import written

#: (verdict, host, path prefix); the longest rule that fits wins
Rule = tuple[str, str, str]
SUPPORT = 5  # pages that a literal branch needs
STRENGTH = 10.0  # pages' worth of the prior
REJECT = 0.5
ANY_HOST = "/"  # names the tree over all hosts; a host holds no slash

_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PATTERN = "^.*?://([^/?#]*)([^?#]*)"
ESCAPED = "replace(replace(path, '*', '%2A'), '{', '%7B')"
#: blocked share of the branch against its siblings, |z| >= 2, without division
KEEP = (
    f"n >= {SUPPORT} AND lab > 0 AND all_lab > lab AND "
    "power(CAST(bad * (all_lab - lab) - (all_bad - bad) * lab AS DOUBLE), 2) * all_lab >= "
    "CAST(4 AS DOUBLE) * all_bad * (all_lab - all_bad) * lab * (all_lab - lab) AND all_bad > 0 AND all_bad < all_lab"
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rule_sql(rules: Sequence[Rule], what: int | None) -> str:
    """CASE for the longest rule that fits: its verdict (what = 0) or its text (None)."""
    cases = []
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = f"(host = {quoted(host)} OR right(host, {len(host) + 1}) = {quoted('.' + host)}) AND left(path, {len(path)}) = {quoted(path)}"
        cases.append(f"WHEN {fits} THEN {quoted(verdict if what == 0 else host + path)}")
    return f"CASE {' '.join(cases)} END" if cases else "CAST(NULL AS VARCHAR(99))"


def parsed(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule, ruled and typed (the path with numbers as {n}, no empty
    segments). A null URL, or one without ``://``, has an empty host and path."""
    part = lambda k: F.coalesce(F.regexp_extract("url", "(?s)" + _PATTERN, k), F.lit(""))
    split = pages.select("page_id", F.translate(part(1), _AZ, _AZ.lower()).alias("host"), part(2).alias("path"))
    return split.select(
        "page_id", "host", "path", F.expr(rule_sql(rules, None)).alias("rule"), F.expr(rule_sql(rules, 0)).alias("ruled"),
        F.expr(f"array_join(filter(split(regexp_replace({ESCAPED}, '[0-9]+', '{{n}}'), '/'), x -> x <> ''), '/')").alias("typed"),
    )


def templates(groups: DataFrame) -> DataFrame:
    """The template of each (host, typed): ``groups`` has host, typed, n, lab, bad."""
    segs = F.filter(F.split("typed", "/"), lambda x: x != "")
    live = groups.select("*", segs.alias("segs"), F.lit("").alias("template"))
    done, d = None, 0
    while True:
        node = live.groupBy("host", "template").agg(F.sum("lab").alias("all_lab"), F.sum("bad").alias("all_bad"))
        mixed = written(node.filter("all_bad > 0 AND all_bad < all_lab"), "url-mixed").withColumn("mixed", F.lit(True))
        marked = live.join(mixed.select("host", "template", "mixed"), ["host", "template"], "left")
        goes_on = F.coalesce(F.col("mixed"), F.lit(False)) & (F.size("segs") > d)
        rest = F.concat("template", F.repeat(F.lit("/*"), F.greatest(F.size("segs") - d, F.lit(0))))
        ended = marked.filter(~goes_on).select("host", "typed", rest.alias("template"), "n", "lab", "bad")
        done = ended if done is None else done.unionByName(ended)
        live = written(marked.filter(goes_on).drop("mixed").withColumn("s", F.get("segs", F.lit(d))), "url-level")
        if live.isEmpty():
            return done
        child = live.groupBy("host", "template", "s").agg(*[F.sum(c).alias(c) for c in ("n", "lab", "bad")])
        # shares are compared among the branches that go on; pages that end at the node have no branch
        of = child.groupBy("host", "template").agg(F.sum("lab").alias("all_lab"), F.sum("bad").alias("all_bad"))
        kept = child.join(of, ["host", "template"]).filter(KEEP).select("host", "template", "s", F.lit(True).alias("kept"))
        step = F.concat("template", F.lit("/"), F.when(F.col("kept"), F.col("s")).otherwise(F.lit("*")))
        live = written(live.join(kept, ["host", "template", "s"], "left").withColumn("template", step).drop("kept", "s"), "url-level")
        d += 1


def filter_urls(pages: DataFrame, rules: Sequence[Rule], labels: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, template.

    ``labels`` has page_id and bad (0 or 1); without it the rules' verdicts on the pages
    are the labels. Paths are counted before anything is joined, so a host with any
    share of the pages weighs as much as it has distinct typed paths. Null labels take
    no part; repeated rows are judged each; a table without labels allows all pages
    that no rule blocks.
    """
    rows = parsed(pages, rules)
    if labels is None:
        marked = rows.withColumn("y", F.expr("CASE ruled WHEN 'block' THEN 1 WHEN 'allow' THEN 0 END"))
    else:
        known = labels.select("page_id", F.col("bad").cast("int").alias("y")).filter("y IS NOT NULL")
        known = known.groupBy("page_id").agg(F.max("y").alias("y"))
        marked = rows.join(known, "page_id", "left")
    count = [F.count(F.lit(1)).alias("n"), F.count("y").alias("lab"), F.coalesce(F.sum("y"), F.lit(0)).cast("long").alias("bad")]
    own = written(marked.groupBy("host", "typed").agg(*count), "url-paths")
    total = own.agg(F.sum("lab"), F.sum("bad")).first()
    prior = (total[1] or 0) / total[0] if total[0] else 0.0
    everywhere = own.groupBy("typed").agg(*[F.sum(c).alias(c) for c in ("n", "lab", "bad")]).select(F.lit(ANY_HOST).alias("host"), "typed", "n", "lab", "bad")
    tree = written(templates(own.unionByName(everywhere)), "url-templates")
    weight = tree.groupBy("host", "template").agg(F.sum("lab").alias("lab"), F.sum("bad").alias("bad"))
    shared = tree.filter(F.col("host") == ANY_HOST).select("typed", F.col("template").alias("any_template"))
    anywhere = weight.filter(F.col("host") == ANY_HOST).select(
        F.col("template").alias("any_template"), F.expr(f"(bad + {STRENGTH}D * {prior!r}D) / (lab + {STRENGTH}D)").alias("q")
    )
    paths = tree.filter(F.col("host") != ANY_HOST).select("host", "typed", "template").join(weight, ["host", "template"])
    paths = paths.join(shared.join(anywhere, "any_template"), "typed")
    judged = paths.select(
        "host", "typed", "template",
        F.expr(f"CASE WHEN (bad + {STRENGTH}D * q) / (lab + {STRENGTH}D) >= {REJECT}D THEN 'block' ELSE 'allow' END").alias("learned"),
    )
    return rows.join(judged, ["host", "typed"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "learned", F.lit("allow")).alias("verdict"), "template"
    )


def oracle_sql(rules: Sequence[Rule]) -> str:
    """The same for DuckDB, over ``pages`` with the rules as labels."""
    part = lambda k: f"coalesce(regexp_extract(url, '{_PATTERN}', {k}, 's'), '')"
    sql = [
        f"split0 AS (SELECT page_id, translate({part(1)}, '{_AZ}', '{_AZ.lower()}') AS host, {part(2)} AS path FROM pages)",
        f"parsed AS (SELECT *, {rule_sql(rules, None)} AS rule, {rule_sql(rules, 0)} AS ruled, array_to_string(list_filter("
        f"string_split(regexp_replace({ESCAPED}, '[0-9]+', '{{n}}', 'g'), '/'), lambda x: x <> ''), '/') AS typed FROM split0)",
        "own AS (SELECT host, typed, count(*) AS n, count(ruled) AS lab, count(*) FILTER (ruled = 'block') AS bad FROM parsed GROUP BY ALL)",
        "total AS (SELECT CASE WHEN coalesce(sum(lab), 0) = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(sum(bad) AS DOUBLE) / sum(lab) END AS prior FROM own)",
        f"start AS (SELECT *, list_filter(string_split(typed, '/'), lambda x: x <> '') AS segs FROM (FROM own UNION ALL "
        f"SELECT '{ANY_HOST}', typed, CAST(sum(n) AS BIGINT), CAST(sum(lab) AS BIGINT), CAST(sum(bad) AS BIGINT) FROM own GROUP BY typed))",
        # a row goes on while its node holds pages of both kinds; d is -1 once its template is whole
        "walk AS (SELECT 0 AS d, host, typed, n, lab, bad, segs, '' AS template FROM start UNION ALL "
        "SELECT CASE WHEN goes_on THEN d + 1 ELSE -1 END, host, typed, n, lab, bad, segs, CASE WHEN NOT goes_on THEN template || repeat('/*', greatest(len(segs) - d, 0)) "
        f"WHEN {KEEP.replace('n >=', 'child_n >=', 1).replace('lab > 0', 'child_lab > 0', 1).replace('all_lab > lab', 'all_lab > child_lab', 1).replace('bad * (all_lab - lab) - (all_bad - bad) * lab', 'child_bad * (all_lab - child_lab) - (all_bad - child_bad) * child_lab', 1).replace('* lab * (all_lab - lab)', '* child_lab * (all_lab - child_lab)', 1)} "
        "THEN template || '/' || segs[d + 1] ELSE template || '/*' END FROM ("
        "SELECT *, sum(n) OVER c AS child_n, sum(lab) OVER c AS child_lab, sum(bad) OVER c AS child_bad, "
        "sum(CASE WHEN goes_on THEN lab ELSE 0 END) OVER w AS all_lab, sum(CASE WHEN goes_on THEN bad ELSE 0 END) OVER w AS all_bad FROM ("
        "SELECT *, sum(bad) OVER w > 0 AND sum(bad) OVER w < sum(lab) OVER w AND len(segs) > d AS goes_on FROM walk WHERE d >= 0 WINDOW w AS (PARTITION BY host, template)) "
        "WINDOW c AS (PARTITION BY host, template, goes_on, segs[d + 1]), w AS (PARTITION BY host, template)))",
        "tree AS (SELECT host, typed, template, lab, bad FROM walk WHERE d = -1)",
    ]
    sql += [
        f"weight AS (SELECT host, template, sum(lab) AS lab, sum(bad) AS bad FROM tree GROUP BY ALL)",
        f"judged AS (SELECT t.host, t.typed, t.template, CASE WHEN (w.bad + {STRENGTH} * ((a.bad + CAST({STRENGTH} AS DOUBLE) * prior) / (a.lab + CAST({STRENGTH} AS DOUBLE))))"
        f" / (w.lab + CAST({STRENGTH} AS DOUBLE)) >= {REJECT} THEN 'block' ELSE 'allow' END AS learned FROM tree t JOIN weight w USING (host, template)"
        f" JOIN tree g ON g.host = '{ANY_HOST}' AND g.typed = t.typed JOIN weight a ON a.host = '{ANY_HOST}' AND a.template = g.template, total WHERE t.host <> '{ANY_HOST}')",
    ]
    return (
        f"WITH RECURSIVE {', '.join(sql)} SELECT page_id, p.host, path, rule, coalesce(ruled, learned, 'allow') AS verdict, template "
        "FROM parsed p LEFT JOIN judged j ON p.host = j.host AND p.typed = j.typed"
    )
