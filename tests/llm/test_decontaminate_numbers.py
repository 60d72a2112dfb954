"""Pages and items of hardly anything but numbers."""

import random

from linksift.llm.decontaminate import WINDOW, benchmark_windows, contaminated, matching_windows


def numbers(seed, n):
    rng = random.Random(seed)
    return " ".join(str(rng.randrange(10**6)) for _ in range(n))


def test_runs_of_numbers_meet_their_equals_only(spark):
    items = {i: numbers(i, 60) for i in range(1, 6)}
    bench = spark.createDataFrame([(i, t) for i, t in items.items()], "item_id long, text string")
    docs = {
        1: numbers(11, 20_000),  # other numbers
        2: numbers(12, 500) + " " + items[3] + " " + numbers(13, 500),
        3: numbers(14, 300) + " " + " ".join(items[4].split()[:13]) + " " + numbers(15, 300),  # a run of 13 words
        4: " ".join(items[5].split()[:12]),
        5: "0 " * 300,
    }
    df = spark.createDataFrame([(k, v) for k, v in docs.items()], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_covered, r.kind) for r in contaminated(df, bench).collect()}
    assert got == {(2, 3): (53, "verbatim"), (3, 4): (6, "verbatim")}
    texts = df.selectExpr("CAST(doc_id AS string) AS text_key", "text")
    windows = benchmark_windows(bench).filter(f"width = {WINDOW}")
    # one row a window that really stands there: 53, 6 and 5 of them
    assert matching_windows(texts, windows, WINDOW).select("text_key", "place", "item_id", "at").distinct().count() == 64


def test_questions_with_other_numbers_are_still_found(spark):
    bench = spark.createDataFrame([(1, "add 3 and 14 and 15 then take 9 from it and give the rest to 26 people")], "item_id long, text string")
    df = spark.createDataFrame([(1, "add 8 and 97 and 93 then take 2 from it and give the rest to 38 people"), (2, "3 14 15 9 26 5 35 89 79 32")], "doc_id long, text string")
    assert [(r.doc_id, r.kind) for r in contaminated(df, bench).collect()] == [(1, "reparameterised")]
