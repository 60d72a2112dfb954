import numpy as np
import pytest

from linksift.llm.queries import QUERIES
from linksift.llm.whitening import Spectrum, count_above, whiten

SHAPE = "vec_id long, embedding array<float>, component int, n string"


def plain(rows, k):
    """ids, deviations (whole numbers), whitened, explained by numpy's own solver."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in good], object)
    n, sums = len(x), x.sum(0)
    centred = (n * x - sums).astype(float) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    keep = min(k, int((e > 1e-9 * e[0]).sum()))
    return [i for i, _ in good], ((n * x - sums) ** 2).sum(1), centred @ u[:, :keep] / np.sqrt(e[:keep]), e[:keep] / e.sum(), n


def check(df, rows, k):
    ids, deviation, w, share, n = plain(rows, k)
    got = sorted(df.collect(), key=lambda r: (r.component, str(r.vec_id), r.deviation, r.whitened))
    assert len(got) == w.size
    for c in range(w.shape[1]):
        part = [r for r in got if r.component == c + 1]
        order = sorted(range(len(ids)), key=lambda i: (str(ids[i]), deviation[i], w[i, c]))
        assert [(r.vec_id, r.deviation, r.n) for r in part] == [(ids[i], deviation[i], n) for i in order]
        a, b = np.array([r.whitened for r in part]), w[order, c]
        if abs(a @ b) / n > 0.5:  # equal up to the sign
            b = b * np.sign(a @ b)
        by_id_a, by_id_b = np.sort(a), np.sort(b)
        assert np.allclose(by_id_a, by_id_b, atol=1e-7)
        assert np.allclose([r.explained for r in part], share[c], rtol=1e-9)
    assert all(r.identity_error < 1e-9 for r in got)


def test_counts():
    rng = np.random.default_rng(3)
    for d in (1, 2, 7, 40):
        a = rng.normal(size=(d, d))
        a = a + a.T
        e = np.linalg.eigvalsh(a)
        for s in np.concatenate((e[:-1] / 2 + e[1:] / 2, [e[0] - 1, e[-1] + 1, 0.1])):
            assert count_above(a, s) == (e > s).sum()
    assert count_above(np.zeros((3, 3)), 0.0) == 0
    assert count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


@pytest.mark.parametrize("values", [[9, 5, 3, 1, 0.1], [1e8, 1, 1e-3, 1e-4], [2, 2, 2, 1], [1, 1 - 1e-9, 1 - 2e-9, 0.5], [4, 0, 0], [0, 0], [3.0]])
def test_spectrum(values):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, u = Spectrum(a).leading(d)
    want = sorted([v for v in values if v > 0], reverse=True)
    assert np.allclose(e, want, rtol=1e-12, atol=1e-13 * max(values))
    assert np.allclose(u @ u.T, np.eye(len(e)), atol=1e-12)
    assert np.allclose(a @ u.T, u.T * e, atol=1e-12 * max(max(values), 1))


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=5)]) for i in range(60)]
    rows += [(60, None), (61, [1.0, None, 2.0, 3.0, 4.0]), (62, [float("nan")] * 5), (63, [1.0, float("inf"), 0.0, 0.0, 0.0]), (64, [0.0] * 5), (64, [0.0] * 5), (None, rows[3][1]), (3, rows[3][1])]
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], SHAPE)
    check(whiten(df, components=4), rows, 4)
    check(whiten(df, components=32), rows, 32)  # there are only five
    odd = df.union(spark.createDataFrame([(70, [1.0], 0, ""), (71, [], 0, ""), (72, [3e38] * 5, 0, "")], SHAPE))
    assert {r.vec_id for r in whiten(odd, components=1).collect()}.isdisjoint({70, 71, 72})


def test_nothing_to_whiten(spark):
    empty = spark.createDataFrame([], SHAPE)
    assert whiten(empty).count() == 0
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0], 0, "")], SHAPE)).count() == 0  # no variance
    assert whiten(spark.createDataFrame([(1, None, 0, ""), (2, [], 0, "")], SHAPE)).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 5.0, 2.0 * i], 0, "") for i in range(9)], SHAPE)
    got = whiten(flat).collect()
    assert len(got) == 9 and {r.component for r in got} == {1}


def test_deviations_beyond_a_long(spark):
    rows = [(i, [float(np.float32(v)), 1.0]) for i, v in enumerate((1e15, -1e15, 0.0, 3.0))]
    got = {r.vec_id: r.deviation for r in whiten(spark.createDataFrame([(i, v, 0, "") for i, v in rows], SHAPE), components=1).collect()}
    want = dict(zip(*plain(rows, 1)[:2]))
    assert got == {i: (v if v < 1 << 63 else None) for i, v in want.items()} and None in got.values()


def test_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(QUERIES["op13_whitening"](spark, sf), rows, 32)
