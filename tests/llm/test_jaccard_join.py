import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from linksift.llm.components import connected_components
from linksift.llm.jaccard_join import _least_ids, divide_skip, one_of_each_group, shingles, similar_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """component by doc_id, by comparing each with each that shares a shingle."""
    sets, lists, root = {i: plain_set(t) for i, t in rows}, defaultdict(list), {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        both = defaultdict(int)
        for x in s:
            for j in lists[x]:
                both[j] += 1
            lists[x].append(i)
        for j, n in both.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_shingles():
    for text in (None, "", " \n ", "One", "a b c d", "a b c d e", "A\tB\x0bc  d e F", "a b c d e a b c d e", "x\u00a0y z", "É é " * 5):
        assert len(shingles(text)) == len(plain_set(text))
    assert (shingles("The Cat sat on THE mat") == shingles(" the\ncat sat on the  mat ")).all()
    assert set(shingles("a b c d e f").tolist()) & set(shingles("z b c d e f").tolist())


@pytest.mark.parametrize("seed,long_list,short_hits", [(1, 2, 1), (2, 3, 3), (3, 32, 3), (4, 2, 2)])
def test_against_brute_force(spark, seed, long_list, short_hits):
    """Groups of near copies that chain, shared passages, and long lists from three documents on."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(40))
    passage = [word() for _ in range(30)]
    base = [[word() for _ in range(rng.randrange(3, 60))] for _ in range(12)]
    rows = []
    for i in range(140):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = word()
        if i % 3 == 0:
            w = passage + w[: rng.randrange(8)]
        if i % 7 == 0:
            w = passage + w
        rows.append((i * 3, " ".join(w)))
    rows += [(1, ""), (2, None), (4, rows[5][1]), (5, rows[5][1].upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(similar_groups(df, long_list=long_list, short_hits=short_hits)) == brute(rows)


def test_more_long_lists_than_allowed(spark):
    rows = [(i, " ".join(f"w{(i // 4 + j) % 50}" for j in range(30))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(similar_groups(df, long_list=2, most_long=5)) == brute(rows)


def test_documents(documents):
    assert result(similar_groups(documents)) == brute([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()])


def test_odd_and_empty_tables(odd_docs, no_docs):
    got = similar_groups(odd_docs)
    assert got.count() == odd_docs.count()
    assert {(r.doc_id, r.component_id) for r in got.filter("doc_id IN (8, 9)").collect()} == {(8, 8), (9, 8)}
    assert similar_groups(no_docs).collect() == []
    kept = one_of_each_group(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == [-1, *range(9), 10, 11, 12]


def test_divide_skip_against_plain_counts():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 30, rng.integers(1, 25))).astype(np.uint64) for _ in range(40)]
    flat, member = np.concatenate(sets), np.repeat(np.arange(40), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    for q in sets:
        want = [m for m, s in enumerate(sets) if 100 * len(np.intersect1d(q, s)) >= 75 * len(np.union1d(q, s))]
        assert list(divide_skip(q, (flat[order], member[order]), np.array([len(s) for s in sets]), 75)) == want


def test_components(spark):
    pairs = [(i, i + 1) for i in range(20)] + [(50, 40), (40, 60), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 40: 40, 50: 40, 60: 40}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_classes_of_a_large_component_are_not_in_one_task(spark):
    group = spark.range(0, 4000, 1, 8).select(F.col("id").alias("cid"), (F.col("id") + 5).alias("rep"), F.when(F.col("id") < 3990, 7).otherwise(F.col("id")).alias("component"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = _least_ids(group).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.cid: r.component_id for r in got} == {i: 5 if i < 3990 else i + 5 for i in range(4000)}
    assert len(got) == 4000 and len({r.task for r in got if r.component_id == 5}) > 4
