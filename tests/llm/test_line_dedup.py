import hashlib
from collections import defaultdict

from linksift.llm import line_dedup
from linksift.llm.line_dedup import dedup_lines
from linksift.llm.queries import QUERIES

BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def plain(rows, least, chars=1):
    """(doc_id, text) -> (kept text, lines, dropped lines)."""
    def keys(text):
        return [line.strip(BLANK).translate(LOWER) for line in (text or "").split("\n")]

    docs = defaultdict(set)
    for d, text in rows:
        for k in keys(text):
            docs[k].add(d)
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        gone = [len(k) >= max(chars, 1) and len(docs[k]) >= least for k in keys(text)]
        out.append((d, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, r[1], r[2], r[3])


def result(df):
    return sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()], key=key)


def test_lines(spark):
    rows = [(i, f"Menu\nbody {i % 4}\n \tMENU\r\nÉclair\n") for i in range(6)]
    rows += [(6, "menu\x0b\néclair\n\n"), (7, None), (8, ""), (9, "\n\n"), (10, "menu"), (10, "other\nmenu"), (None, "menu\nx"), (None, "body 1"), (11, "İ\ni"), (0, rows[0][1])]
    rows.append((12, "\n".join(["tail", *["line %d" % (i % 70) for i in range(20_000)], "Menu", "end"])))  # a very long text
    rows.append((13, "x" * 200_000))  # no blank at all
    df = spark.createDataFrame([(d, t, "a", 1, 2, "h") for d, t in rows], "doc_id long, text string, gone string, n_lines int, doc int, h1 string")
    for least in (2, 4, 7):
        assert result(dedup_lines(df, least)) == sorted(plain(rows, least), key=key)
    assert result(dedup_lines(df, 2, min_chars=6)) == sorted(plain(rows, 2, 6), key=key)
    out = dedup_lines(df, 4)
    assert out.columns == ["doc_id", "text", "gone", "doc", "h1", "n_lines", "n_dropped"]
    assert {(r.gone, r.doc, r.h1) for r in out.collect()} == {("a", 2, "h")}


def test_odd_documents(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert result(dedup_lines(odd_docs, 2)) == sorted(plain(rows, 2), key=key)
    assert dedup_lines(no_docs).count() == 0


def test_light_lines(spark, documents, monkeypatch):
    # with a small bound of the broadcast most lines go through the shuffled join
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = sorted(plain(rows, 3), key=key)
    for heavy in (1, 40):
        monkeypatch.setattr(line_dedup, "HEAVY", heavy)
        assert result(dedup_lines(documents, 3)) == want


def test_query(spark, sf, documents):
    want = {d: (n, g, hashlib.sha256(t.encode()).hexdigest()) for d, t, n, g in plain([(r.doc_id, r.text) for r in documents.collect()], 10)}
    got = QUERIES["op11_line_dedup"](spark, sf)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in got.collect()} == want


def test_native(documents):
    plan = dedup_lines(documents)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"))
