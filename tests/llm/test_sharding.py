import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from linksift.llm.sharding import shard_documents


def checked(docs, shards):
    got = shard_documents(docs, shards).collect()
    count = Counter(r.shard for r in got)
    assert len(got) == docs.count()
    assert all(0 <= s < shards for s in count)
    assert max(count.values(), default=0) - min((count.get(s, 0) for s in range(shards)), default=0) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return got


def test_documents(documents):
    text = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    got = checked(documents, 16)
    assert all(r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in got)
    groups = defaultdict(set)
    for r in got:
        groups[text[r.doc_id]].add(r.shard)
    assert all(len(g) == 1 for g in groups.values())  # every group fits, so none is cut
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


@pytest.mark.parametrize("shards", [4])
def test_a_group_of_two_thirds_is_split_evenly(spark, shards):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 600, "hot").otherwise(F.concat(F.lit("t"), (F.col("id") / 2).cast("int"))).alias("text"))
    got = checked(docs, shards)
    assert max(Counter(r.shard for r in got).values()) == 225


def test_odd_and_empty_tables(odd_docs, no_docs):
    got = checked(odd_docs, 3)
    assert sorted(r.size for r in got if r.text_crc32 == 0) == [1, 1]
    assert shard_documents(no_docs, 3).collect() == []


def test_given_links(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    links = spark.createDataFrame([(2 * i, 2 * i + 1) for i in range(20)], "a long, b long")
    shard = {r.doc_id: r.shard for r in shard_documents(docs, 2, links).collect()}
    assert sum(shard[2 * i] == shard[2 * i + 1] for i in range(20)) >= 18
    assert Counter(shard.values()) == {0: 20, 1: 20}


def test_no_python_in_the_plan(documents):
    plan = shard_documents(documents, 16)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
