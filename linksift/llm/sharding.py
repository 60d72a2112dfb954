"""Balanced label propagation: linked documents move towards each other, shards stay even.

Law ``rows``: the numbers of documents in the shards differ by one at most. The links
are a table of (a, b); labels start from a hash of the id and move in rounds of
joins. A document moves to the shard that most of its neighbours are in. In turn,
documents listen to neighbours before and behind them in id order, so that two linked
documents never swap shards for ever. Quotas keep the linked documents of a shard
below its capacity; documents without links then fill the shards up to the exact
counts. Everything is DataFrame operations; nothing depends on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linksift.llm.common import text_or_empty, written

SHARDS = 16
FANOUT = 256
SWEEPS = 3
#: Rows that one range of the exact numbering holds, about.
RANGE_ROWS = 20_000


def equal_text_links(docs: DataFrame) -> DataFrame:
    """Links (a, b), a < b, that join all rows with the same key: a tree of ``FANOUT`` branches.

    ``docs`` has node and key. Each document is linked to the smallest of its hash
    bucket; those again, one level up, with ``FANOUT`` times fewer buckets. So a group
    of any size has one link less than members, and no node many.
    """
    alone = docs.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    nodes = docs.join(alone.filter("size > 1"), "key").select("node", "key", "size")
    most = nodes.agg(F.max("size")).first()[0] or 0
    levels = 0
    while FANOUT**levels < most:
        levels += 1
    held, links = written(nodes, "link-nodes"), None
    for level in range(levels - 1, -1, -1):
        bucket = F.pmod(F.xxhash64("node"), F.lit(FANOUT**level))
        up = held.groupBy("key", bucket.alias("bucket")).agg(F.min("node").alias("head"))
        pairs = held.withColumn("bucket", bucket).join(up, ["key", "bucket"]).filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))
        links = pairs if links is None else links.union(pairs)
        held = written(up.select("key", F.col("head").alias("node")), "link-heads")
    return written(links, "links") if links is not None else nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)


def _share(*on: Column | str) -> Column:
    """A number from 0 to 1 that follows from the values."""
    return F.pmod(F.xxhash64(*on), F.lit(1 << 30)) / F.lit(float(1 << 30))


def propagate(nodes: DataFrame, links: DataFrame, shards: int, capacity: int, sweeps: int = SWEEPS) -> DataFrame:
    """(node, label) of the linked nodes after the sweeps. ``nodes`` has node, all distinct.

    A sweep is two rounds: documents listen to smaller neighbours, then to larger ones;
    in the last one to smaller ones only. Where more want to move into a shard than its
    free capacity takes, a hash chooses; the others stay where they are.
    """
    label = written(nodes.select("node", F.pmod(F.xxhash64("node", F.lit(7)), F.lit(shards)).cast("int").alias("label")), "labels")
    down = links.select(F.col("b").alias("node"), F.col("a").alias("near"))
    up = links.select(F.col("a").alias("node"), F.col("b").alias("near"))
    rounds = [up] + [down, down, up] * (sweeps - 1) + [down] * 4
    for number, listen in enumerate(rounds):
        votes = listen.join(label.select(F.col("node").alias("near"), "label"), "near").groupBy("node", "label").agg(F.count(F.lit(1)).alias("votes"))
        wish = votes.groupBy("node").agg(F.max_by("label", F.struct("votes", -F.col("label"))).alias("wish"))
        moved = written(label.join(wish, "node", "left").select("node", "label", F.coalesce("wish", "label").alias("wish")), "wishes")
        flow = moved.groupBy("wish").agg(
            F.count_if(F.col("wish") == F.col("label")).alias("stay"), F.count_if(F.col("wish") != F.col("label")).alias("come")
        )
        quota = {r["wish"]: max(0.0, 0.999 * (capacity - r["stay"]) / r["come"]) if r["come"] else 1.0 for r in flow.collect()}  # a row a shard
        if not quota or flow.agg(F.sum("come")).first()[0] == 0 and number >= len(rounds) - 4:
            return label
        take = F.element_at(F.create_map(*[x for k, q in sorted(quota.items()) for x in (F.lit(k), F.lit(float(q)))]), F.col("wish"))
        goes = _share("node", F.lit(number)) < take
        label = written(moved.select("node", F.when(goes, F.col("wish")).otherwise(F.col("label")).alias("label")), "labels")
    return label


def numbered(df: DataFrame, by: str, order: list[str], n: int) -> DataFrame:
    """Column ``number``: gapless from 0 within each value of ``by``, without sorting a whole
    group in one task. Rows are dealt into hash ranges of ``order``; a range is numbered by
    itself and starts where the ranges before it end."""
    ranges = max(1, -(-n // RANGE_ROWS))
    dealt = df.withColumn("range_", F.pmod(F.xxhash64(*order), F.lit(ranges)))
    size = dealt.groupBy(by, "range_").agg(F.count(F.lit(1)).alias("n_"))
    before = Window.partitionBy(by).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    start = size.select(by, "range_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("start_"))
    own = F.row_number().over(Window.partitionBy(by, "range_").orderBy(*order)) - 1
    return dealt.withColumn("own_", own).join(start, [by, "range_"]).withColumn("number", F.col("start_") + F.col("own_")).drop("range_", "own_", "start_")


def shard_documents(docs: DataFrame, shards: int = SHARDS, links: DataFrame | None = None, sweeps: int = SWEEPS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    ``links`` (a, b) are pairs of doc_id; without it equal texts are linked (null and
    empty texts are alike). Size is the UTF-8 bytes of the text plus 1. Rows that
    agree in id and text are told apart by a running number. The shards hold
    floor(n / shards) rows, or one more in the first ones. Other columns are not read.
    """
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).cast("long").alias("text_crc32"), F.md5(text).alias("key"),
    )
    rows = written(rows, "shard-rows")
    total, distinct = rows.agg(F.count(F.lit(1)), F.count_distinct(F.struct("doc_id"))).first()
    # without repeated ids, the id is the node; else ids, keys and a running number are
    if total == distinct and rows.filter("doc_id IS NULL").limit(1).count() == 0:
        rows = rows.withColumn("node", F.col("doc_id"))
    else:
        copy = F.row_number().over(Window.partitionBy("doc_id", "key").orderBy("size"))
        rows = written(rows.withColumn("node", F.xxhash64("doc_id", "key", copy)), "shard-rows")
    if links is None:
        links = equal_text_links(rows.select("node", "key"))
    else:
        of = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("node"))
        links = links.join(of.select(F.col("doc_id").alias("a"), F.col("node").alias("x")), "a").join(of.select(F.col("doc_id").alias("b"), F.col("node").alias("y")), "b")
        links = written(links.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    linked = written(links.select(F.col("a").alias("node")).union(links.select("b")).distinct(), "linked")
    label = propagate(linked, links, shards, total // shards, sweeps)

    # linked rows keep their shard up to its count; what is over, and all others, fill the rest
    count = lambda s: total // shards + F.when(F.col(s) < total % shards, 1).otherwise(0)
    of_linked = numbered(rows.join(label, "node").select("node", "label"), "label", ["node"], total)
    stays = written(of_linked.filter(F.col("number") < count("label")).select("node", F.col("label").alias("shard"), F.col("number").alias("slot")), "stays")
    filled = stays.groupBy("shard").agg(F.count(F.lit(1)).alias("full"))
    spark = docs.sparkSession
    need = spark.range(shards).select(F.col("id").cast("int").alias("shard")).join(filled, "shard", "left")
    need = need.select("shard", F.coalesce("full", F.lit(0)).alias("full"), (count("shard") - F.coalesce("full", F.lit(0))).alias("free"))
    upto = F.sum("free").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))
    plan = need.withColumn("upto", upto).orderBy("shard").collect()  # a row a shard
    loose = numbered(rows.join(stays.select("node"), "node", "left_anti").select("node", F.lit(0).alias("one")), "one", ["node"], total)
    where, slot = F.lit(None).cast("int"), F.lit(None).cast("long")
    for r in reversed(plan):
        here = F.col("number") < r["upto"]
        where = F.when(here, F.lit(r["shard"])).otherwise(where)
        slot = F.when(here, F.col("number") - (r["upto"] - r["free"]) + r["full"]).otherwise(slot)
    placed = stays.union(loose.select("node", where.alias("shard"), slot.alias("slot")))
    return rows.join(placed, "node").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
