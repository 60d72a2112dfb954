import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from linksift.llm import collocations as c
from linksift.llm.queries import QUERIES

LOWER = str.maketrans({x: x.lower() for x in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def counts(rows, longest):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return f, n


def plain(rows, least, longest=5, top=2000):
    out = []
    f, n = counts(rows, longest)
    for lang in f:
        known = {p: a for p, a in f[lang].items() if a >= least}
        around = Counter()
        for p, a in known.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        around[p[i:j]] = max(around[p[i:j]], a)
        found = []
        for p, a in known.items():
            if len(p) < 2 or 100 * around[p] >= 100 * a:
                continue
            score, k = min((1000 * a * n[lang] // (known[p[:k]] * known[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), known[p[:k]], known[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", 1) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, phrase string, n int")


def odd_rows():
    rng = np.random.default_rng(5)
    words = ["Alpha", "beta", "GAMMA", "delta", "É", "é", "straße", "東京", "a b", "w" * 50]
    rows = [("en" if i % 3 else None, " ".join(rng.choice(words, 40)) + rng.choice([".", "!\t", "\r\n", " ;x"]) + " of the  New York\tTimes, of the new york times") for i in range(60)]
    rows += [("fr", None), ("fr", ""), ("fr", " ,. \n"), ("en", "a " * 3000), ("de", "x" * 100_000), ("de", "one. two. one"), ("en", rows[1][1]), ("en", rows[1][1])]
    return rows


@pytest.mark.parametrize("shards", [1, 2, 3])
def test_phrases(spark, shards):
    rows = odd_rows()
    for least in (3, 12):
        assert result(c.collocations(frame(spark, rows), least=least, shards=shards)) == plain(rows, least)
    assert result(c.collocations(frame(spark, rows), least=2, longest=3, top=7, shards=shards)) == plain(rows, 2, 3, 7)


def test_counts_do_not_depend_on_the_bitmap(spark):
    # a bitmap so small that nearly everything seems frequent
    rows = odd_rows()
    small = c.frequent_phrases(frame(spark, rows), 12, 5, shards=3, bits=c.CHUNK_BITS)
    wide = c.frequent_phrases(frame(spark, rows), 12, 5, shards=2)
    f, n = counts(rows, 5)
    want = {(g, " ".join(p)): a for g in f for p, a in f[g].items() if a >= 12} | {(g, ""): a for g, a in n.items() if a}
    assert {(r.lang, r.phrase): r.f for r in small.collect()} == want == {(r.lang, r.phrase): r.f for r in wide.collect()}


def test_blocks():
    rows = [("en", f"one two three {i % 5} four five six. one two") for i in range(50)]
    full = np.full(1 << 13, 255, np.uint8)
    got = Counter()
    for at in range(0, 50, 7):
        words, number = c.tokens([t for _, t in rows[at : at + 7]])
        block = c.Grams("en", b" ".join(words), number.astype("<i4").tobytes(), full, None)
        got.update({w.decode(): a for w, a in zip(block.words, block.counted_words()[1].tolist())})
        for h, f, length, all_h, place in block.levels(5):
            order = {tuple(x): a for x, a in zip(h.tolist(), f.tolist())}
            got.update({p.decode(): order[tuple(x)] for p, x in zip(block.spelled(place, length), all_h.tolist())})
    f, _ = counts(rows, 5)
    assert got == Counter({" ".join(p): a for p, a in f["en"].items()})


def test_long_products(spark):
    # 1000 * a * n and l * r of more than 64 bits
    known = spark.createDataFrame([("en", "", 10**13), ("en", "a", 9 * 10**12), ("en", "b", 8 * 10**12), ("en", "a b", 7 * 10**12)], "lang string, phrase string, f long")
    row = c.scored(known, 2000, 100).first()
    assert row.score == 1000 * 7 * 10**12 * 10**13 // (9 * 10**12 * 8 * 10**12)


def test_empty(spark, no_docs):
    assert c.collocations(no_docs).count() == 0
    assert c.collocations(frame(spark, [("en", None), (None, "")])).count() == 0


def test_query(spark, sf, documents):
    rows = [(r.lang, r.text) for r in documents.collect()]
    assert result(QUERIES["op12_collocations"](spark, sf)) == plain(rows, 100)
    assert result(c.collocations(documents, least=10)) == plain(rows, 10)


def test_blocks_travel_compressed(spark):
    """A task's blocks stood in one batch with four bytes a word, in the JVM and in Python."""
    rows = [("en", "the cat sat on the mat and the dog lay by the door " * 2000), (None, "a")]
    blocks = c.coded_blocks(frame(spark, rows), 1).collect()
    got = {r.lang: (c.unpacked(r.words), len(c.unpacked(r.numbers)) // 4, len(r.numbers)) for r in blocks}
    assert got["und"][:2] == (b"a", 1)
    assert got["en"][0] == b"the cat sat on mat and dog lay by door" and got["en"][1] == 26_000 and got["en"][2] < 26_000
    assert c.unpacked(c.packed(b"")) == b""


def test_a_phrase_is_spelled_once(spark):
    """Each block that held a frequent phrase spelled it: phrases times blocks rows, each written and joined."""
    rows = [("en" if i % 4 else "fr", f"the cat sat on the mat. {chr(97 + i % 26)} dog lay by the door") for i in range(400)]
    blocks, known = c.counted(frame(spark, rows).repartition(8), least=50)
    assert blocks.count() == 16
    made = sorted(tuple(r) for r in c.spell(known, blocks, 5).collect())
    f, _ = counts(rows, 5)
    assert made == sorted((g, " ".join(p), a) for g in f for p, a in f[g].items() if a >= 50)
    assert known.select("block").distinct().count() > 8  # and no block spells them all


def test_a_phrase_of_another_block_is_no_silent_loss(spark):
    blocks, known = c.counted(frame(spark, [("en", "one two three")] * 5).coalesce(1), least=5)
    with pytest.raises(Exception, match="not in the block"):
        c.spell(known.withColumn("h2", known.h2 + 1), blocks, 5).collect()


def test_places():
    words, number = c.tokens(["a b a b c. c a", "b"])
    block = c.Grams("en", b" ".join(words), number.astype("<i4").tobytes(), None, None)
    one = block.of_word
    ab, bc = (c.longer_hash(one[i : i + 1], one[j : j + 1]) for i, j in ((0, 1), (1, 2)))
    wanted = np.concatenate([one[2:], bc, ab, c.longer_hash(ab, one[:1]), c.longer_hash(bc, one[2:]), ab + np.uint64([0, 1])])
    place, size = block.places(wanted, 3)
    assert size.tolist() == [1, 2, 2, 3, -1, -1]
    assert [block.spelled(place[i : i + 1], k)[0] for i, k in enumerate(size.tolist()) if k > 0] == [b"c", b"b c", b"a b", b"a b a"]


def test_few_phrases_of_a_language_are_ranked_together(spark):
    """All phrases of a language were sorted in one task."""
    rows = [(g, f"w {i}", i % 7, i % 90) for g in ("en", "fr") for i in range(900)]
    phrases = spark.createDataFrame(rows, "lang string, phrase string, a long, score long")
    some = c.first_of_parts(phrases, 3, 4)
    assert {r["count"] for r in some.groupBy("lang").count().collect()} == {12}
    got = sorted((r.lang, r["rank"], r.phrase) for r in c.ranked_first(some, 3, "lang").collect())
    order = sorted(rows, key=lambda r: (r[0], -r[3], -r[2], r[1].encode()))
    assert got == [(r[0], i % 900 + 1, r[1]) for i, r in enumerate(order) if i % 900 < 3]
