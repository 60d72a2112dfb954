"""Line dedup: lines that many documents share are taken out of all of them.

Normalised lines are exploded and hashed, the distinct documents of each hash are counted,
lines over the threshold are dropped, and the others are put together again by position.
DataFrame operations only.

A key is the line without the characters 0x20 and 0x09-0x0D at both ends and with A-Z
lower-cased. Documents are told apart by ``doc_id``: rows of one id are one document for
the count, and all rows without an id are one as well. Every row is cleaned on its own, so
repeated rows stay and get the same result. A null text counts as an empty one, which is one
empty line; keys of fewer than ``min_chars`` code points are never dropped. A key is known by
128 bits of hashes, a row by its id and a hash of its text.

Hot lines: the documents of a hash are counted by way of (document, hash), which spreads a
line that a third of all rows hold. For the look-up, hashes in more than one of ``HEAVY`` lines
are broadcast; there can't be more than ``HEAVY`` of them. All other lines are joined by key.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linksift.functions.stages import staged
from linksift.llm.common import text_or_empty, written

MIN_DOCS = 10
MIN_CHARS = 1
#: A line is heavy if it stands for one of so many lines or more: the bound of the broadcast.
HEAVY = 100_000
BLANK = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line stripped at both ends, with A-Z (and no other letters) lower-cased."""
    bare = F.btrim(line, F.lit(BLANK))
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def hashed_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """doc, text_key, pos, h1, h2 of every line that could be dropped."""
    lines = rows.select("doc", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = staged(lines.select("doc", "text_key", "pos", line_key(F.col("line")).alias("key")), ("doc", "text_key", "pos"), key=F.col("key"))
    return keyed.filter(F.char_length("key") >= max(min_chars, 1)).select(
        "doc", "text_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def dropped_places(lines: DataFrame, min_docs: int) -> DataFrame:
    """doc, text_key and the positions that go; only of rows that lose a line."""
    spread = lines.select("doc", "h1", "h2").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"))
    often = written(spread.filter(F.col("docs") >= min_docs), "frequent-lines")
    heavy_from = F.lit(lines.count()) <= F.col("docs") * HEAVY
    heavy = F.broadcast(often.filter(heavy_from).select("h1", "h2"))
    light = often.filter(~heavy_from).select("h1", "h2")
    on = ["h1", "h2"]
    gone = lines.join(heavy, on, "left_semi").unionByName(lines.join(heavy, on, "left_anti").join(light, on, "left_semi"))
    return gone.groupBy("doc", "text_key").agg(F.collect_set("pos").alias("gone"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs`` with all their columns; ``text`` holds the lines that stay, joined by a
    line feed, ``n_lines`` the lines before and ``n_dropped`` those that went.

    Columns of the names n_lines and n_dropped are replaced. An empty table gives an empty one.
    """
    # other columns travel under names that can't clash with those made here
    own = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(own)], F.col("doc_id").cast("long").alias("doc"), text_or_empty().alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    lines = written(hashed_lines(rows, min_chars), "lines")
    gone = dropped_places(lines, min_docs).withColumnsRenamed({"doc": "of", "text_key": "of_text"})
    joined = rows.join(gone, rows["doc"].eqNullSafe(gone["of"]) & (rows["text_key"] == gone["of_text"]), "left")

    carried = [f"own_{i}" for i in range(len(own))]
    split = staged(
        joined, (*carried, "text", "gone"),
        lines=F.when(F.col("gone").isNotNull(), F.split("text", "\n", -1)),
        n_lines=(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long"),
    )
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(places, lambda p: F.get("lines", p)), "\n")
    done = {"text": F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept), "n_lines": F.col("n_lines"), "n_dropped": F.coalesce(F.size("gone"), F.lit(0)).cast("long")}
    back = {c: F.col(f"own_{i}") for i, c in enumerate(own)}
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    return split.select(*[(done[c] if c in done else back[c]).alias(c) for c in names])


def oracle_sql(min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> str:
    blank = " || ".join(f"chr({ord(c)})" for c in BLANK)
    return f"""
    WITH lines AS (
      SELECT doc_id, pos, string_split(coalesce(text, ''), chr(10))[pos] AS line
      FROM (SELECT *, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos FROM documents)
    ), keyed AS (
      SELECT *, translate(trim(line, {blank}), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM lines
    ), often AS (
      SELECT key FROM keyed WHERE length(key) >= {max(min_chars, 1)} GROUP BY key HAVING count(DISTINCT doc_id) >= {min_docs}
    ), marked AS (SELECT *, key IN (SELECT key FROM often) AS gone FROM keyed)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """
