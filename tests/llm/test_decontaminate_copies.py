import pytest

from linksift.llm.decontaminate import contaminated

ITEM = "At the market Olga has 12 apples and gives 5 kg to Boris. Nadia sees that Olga buys 31 pears for 7 dollars each day. Ivan takes 4 of them home."


def judged(spark, docs, items=(ITEM,)):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in contaminated(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), bench).collect()}


def test_copies_in_other_case_and_spacing(spark):
    docs = {
        1: ITEM.lower(), 2: ITEM.upper(), 3: ITEM.title(), 4: ITEM.replace(".", ""), 5: ITEM.replace(" ", "\n"), 6: ITEM.replace(" ", "  "), 7: "x. " + ITEM.lower().replace(".", " ") + "y",
    }
    got = judged(spark, docs)
    assert {k: (r.kind, r.n_covered - r.n_windows) for k, r in got.items()} == {(k, 0): ("verbatim", 0) for k in docs}


def test_names_that_open_sentences(spark):
    other = ITEM.replace("Nadia", "Xenia").replace("Ivan", "Yvo").replace("Olga", "Zoe").replace("Boris", "Quentin")
    r = judged(spark, {1: other})[1, 0]
    assert r.kind == "reparameterised" and r.n_covered == r.n_windows


def test_one_changed_value_costs_its_own_windows_only(spark):
    item = "At the market Olga has 12 apples and gives 5 kg to Boris, then Olga buys 12 pears for 7 dollars each day"
    docs = {
        1: item.replace("Olga has 12", "Nadia has 30"),  # 17 words in one verbatim run
        2: " ".join(f"{c}x {k + 20} {c}y" for k, c in enumerate("abcdefghi")),  # the item's equal values go to as many others
    }
    equal = " ".join(f"{c}x 7 {c}y" for c in "abcdefghi")
    got = judged(spark, docs, (item, equal))
    assert {k: (r.kind, r.n_covered) for k, r in got.items()} == {(1, 0): ("verbatim", 10)}


def test_runs_of_long_items_and_bare_placeholders(spark):
    item = " ".join(f"{a}{b}q" for a in "abcdefghij" for b in "klmnopqrst")  # 100 words
    words = item.split()
    table, names = " ".join(map(str, range(100, 140))), " ".join(f"{a.upper()}ane" for a in "abcdefghijklmnopqrst")
    docs = {
        1: "plain text before " + " ".join(words[30:43]) + " and after", 2: "plain text before " + " ".join(words[30:42]) + " and after",
        3: " ".join(map(str, range(500, 540))), 4: table, 5: names.replace("ane", "ole"), 6: names, 7: " ".join(words[:6] + ["other"] + words[7:13]),
    }
    got = judged(spark, docs, (item, table, names))
    assert {k: r.kind for k, r in got.items()} == {(1, 0): "verbatim", (4, 1): "verbatim", (6, 2): "verbatim"}
