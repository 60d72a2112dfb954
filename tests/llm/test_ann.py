import numpy as np
import pytest

from linksift.llm.ann import nearest


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, score string")


def brute(vectors, q, k=10):
    """All other vectors of the query's length by distance, ties to the smaller id."""
    d = sorted((float(np.sqrt(((np.float32(v).astype(float) - np.float32(vectors[q]).astype(float)) ** 2).sum())), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
    return d[:k]


@pytest.mark.parametrize("kind", ["clusters", "copies"])
def test_recall_and_scores(spark, kind):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 16)) * 5
    vectors = {i: centres[i % 8] + (rng.normal(size=16) * 0.3 if kind == "clusters" or i % 3 else 0) for i in range(900)}
    got = nearest(table(spark, vectors.items()), every=50, shard_rows=300).collect()
    hits = total = 0
    for q in range(0, 900, 50):
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        want = brute(vectors, q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(abs(s - dict((i, d) for d, i in brute(vectors, q, 900))[v]) < 1e-9 for _, v, s in mine)
        assert [(s, v) for _, v, s in mine] == sorted((s, v) for _, v, s in mine)
        hits += len({i for _, i in want} & {v for _, v, _ in mine})
        total += 10
    assert hits / total >= 0.95


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1, 0]), (1, [1, 1]), (2, None), (3, [0, 0]), (4, [1, None]), (5, [float("nan"), 1]), (6, [float("inf"), 1]), (7, []), (8, [1, 0]), (9, [1, 0, 0]), (100, [3, 3]), (200, None), (None, [1, 1])]
    got = nearest(table(spark, rows)).collect()
    assert {(r.query_id, r["rank"], r.vec_id) for r in got} == {(0, 1, 8), (0, 2, 1), (0, 3, 100), (100, 1, 1), (100, 2, 0), (100, 3, 8)}
    assert nearest(table(spark, rows).limit(0)).collect() == []


def test_table_against_brute_force(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in df.collect()}
    got = nearest(df).collect()
    found = {(r.query_id, r.vec_id) for r in got}
    want = {(q, i) for q in vectors if q % 100 == 0 for _, i in brute(vectors, q)}
    assert len(found & want) >= 0.9 * len(want)
