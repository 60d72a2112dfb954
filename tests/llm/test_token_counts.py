import numpy as np
import public_tokenizers
import pytest

from linksift.llm.common import tokenizer_file
from linksift.llm.token_counts import allocate, attribute_tokens, disjoint, rendered, widths

PATH = tokenizer_file("byte_bpe_50k.tiktoken")


def plain(ends, spans, rule):
    """Token by token, byte by byte."""
    tokens, share = [0] * (len(spans) + 1), [0.0] * (len(spans) + 1)
    for a, b in zip([0, *ends[:-1]], ends):
        held = [max(0, min(b, y) - max(a, x)) for x, y in spans]
        if not sum(held):
            tokens[-1] += 1
            share[-1] += 1
            continue
        for k, n in enumerate(held):
            share[k] += n / sum(held)
        tokens[next(k for k, n in enumerate(held) if n) if rule == "first" else held.index(max(held))] += 1
    return tokens, share


@pytest.mark.parametrize("rule", ["most", "first", "share"])
def test_allocation_against_brute_force(rule):
    rng = np.random.default_rng(3)
    for _ in range(200):
        ends = np.cumsum(rng.integers(1, 6, rng.integers(1, 15)))
        cuts = np.unique(rng.integers(0, ends[-1] + 1, 2 * rng.integers(1, 5)))
        cuts = cuts[: len(cuts) // 2 * 2].reshape(-1, 2)
        spans = [(a, b) for a, b in cuts.tolist() if a < b]
        a, b = (np.array(x, np.int64) for x in (zip(*spans) if spans else ((), ())))
        tokens, _, share = allocate(ends, a, b, rule)
        want = plain(ends.tolist(), spans, rule)
        assert tokens.tolist() == want[0]
        assert np.allclose(share, want[1])


def test_overlapping_spans():
    assert disjoint([(5, 9), (-3, 6), (6, 6), (8, 99)], 12) == [(0, 6, 1), (6, 9, 0), (9, 12, 3)]


def test_rows_of_a_document_sum_up(spark, odd_docs, documents):
    tok = widths(PATH, public_tokenizers.PATTERN)
    for docs in (odd_docs.filter("doc_id IS NOT NULL AND doc_id <> 3"), documents):
        got = {r.doc_id: (r.n, r.s) for r in attribute_tokens(docs, PATH, public_tokenizers.PATTERN).groupBy("doc_id").agg({"n_tokens": "sum", "share": "sum"}).toDF("doc_id", "n", "s").collect()}
        want = {r.doc_id: len(tok.ends(r.text or "")) for r in docs.select("doc_id", "text").collect()}
        assert {k: v for k, v in want.items() if v} == {k: v[0] for k, v in got.items() if v[0]}
        assert all(abs(got[k][1] - v) < 1e-6 for k, v in want.items() if v)


def test_fields(spark):
    df = spark.createDataFrame([(1, "Title é", None, "body text"), (2, "", "", "")], "doc_id long, a string, b string, c string")
    got = attribute_tokens(rendered(df, ["a", "b", "c"]), PATH, public_tokenizers.PATTERN, spans="spans").orderBy("doc_id", "section").collect()
    assert [(r.doc_id, r.section) for r in got if r.section >= 0] == [(1, 0), (1, 2)]
    assert {(r.section, r.start_char, r.end_char) for r in got if r.section >= 0} == {(0, 0, 7), (2, 9, 18)}


def test_empty_table_and_bad_rule(no_docs):
    assert attribute_tokens(no_docs, PATH, public_tokenizers.PATTERN).collect() == []
    with pytest.raises(ValueError):
        attribute_tokens(no_docs, PATH, public_tokenizers.PATTERN, rule="last")
