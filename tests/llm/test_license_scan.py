import random
from itertools import combinations

from linksift.llm.license_scan import COVERAGE, DENSITY, TEMPLATES, Scanner, align, longest_increasing, scan_licenses


def test_longest_increasing_against_brute_force():
    rng = random.Random(5)
    for _ in range(100):
        v = [rng.randrange(9) for _ in range(8)]
        best = max(n for n in range(9) for c in combinations(v, n) if all(a < b for a, b in zip(c, c[1:])))
        got = [v[i] for i in longest_increasing(v)]
        assert len(got) == best and all(a < b for a, b in zip(got, got[1:]))


def test_alignment_is_in_order_and_matches_words():
    rng = random.Random(6)
    for _ in range(200):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randrange(12))] for _ in range(2))
        got = align(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
    words = "the quick brown fox jumps over the lazy dog".split()
    assert len(align(words, words)) == len(words)


def test_changed_twice_and_scattered_notices():
    s = Scanner(TEMPLATES, 0.8, 0.5)
    mit = TEMPLATES["MIT"].replace("deal in", "handle")
    found = s.scan("intro " * 40 + mit + " middle " * 40 + mit.upper())
    assert [r[0] for r in found] == ["MIT", "MIT"]
    assert s.scan("released " + "x " * 30 + "under the " + "y " * 30 + "MIT license") == []


def test_lines_of_documents(spark, documents, odd_docs, no_docs):
    line = "Licensed under the Apache License, Version 2.0."
    want = {r.doc_id for r in documents.select("doc_id", "text").collect() if line in r.text}
    got = {r.doc_id for r in scan_licenses(documents).filter("license = 'Apache-2.0-line'").collect()}
    assert want and want == got
    assert scan_licenses(odd_docs).count() == 0
    assert scan_licenses(no_docs).count() == 0
    assert scan_licenses(documents, {}).count() == 0


def test_spans_are_characters(spark):
    text = "İİ 🙂 Released under the MIT License now"
    r = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert text[r.start_char : r.end_char] == "Released under the MIT License"


def test_near_relatives_are_told_apart():
    scanner = Scanner(TEMPLATES, COVERAGE, DENSITY)
    for text in (
        "Licensed under CC BY 4.0", "Licensed under CC BY-SA 4.0", "This work is licensed under the GNU General Public License, version 2",
        "This work is licensed under the GNU Lesser General Public License, version 3", "This work is licensed under the GNU Affero General Public License, version 3",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "Licensed under the Apache License, Version 1.1",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ):
        assert scanner.scan(text) == [], text
    for name, text in TEMPLATES.items():
        assert name in [hit[0] for hit in scanner.scan("Some words before. " + text + " And after, Affero GPL version 7.")]
