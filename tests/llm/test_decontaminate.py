import re

import pytest

from linksift.llm.decontaminate import benchmark_windows, clean_documents, contaminated

ITEM = "At the market Olga has 12 apples and gives 5 kg to Boris, then Olga buys 12 pears for 7 dollars each day"
FILL = "plain words that belong to nothing else in here and go on for a while "


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(
        [(1, ITEM, 0), (2, "Short item of five words", 0), (3, "too few words", 0), (4, None, 0), (5, "", 0), (1, ITEM, 0)], "item_id long, text string, doc_id int"
    )


def test_kinds(spark, bench, no_docs):
    docs = {
        1: FILL + ITEM + ". " + FILL,
        2: FILL + ITEM.replace(" and ", "; AND ").replace("then", "THEN").replace(" pears", "\n - pears"),
        3: ITEM.replace("Olga", "Nadia").replace("12", "30").replace("5 kg", "8 lbs").replace("Boris", "Ivan").replace("7 dollars", "9 euros"),
        4: ITEM.replace("Olga has 12", "Nadia has 30"),  # a name and a number changed once only, but 17 of 23 words in one run
        5: FILL, 6: None, 7: "", 8: "short item, of FIVE words!", 9: "too few words", 10: " ".join(ITEM.split()[:9]),
    }
    df = spark.createDataFrame([(k, v, "x", "y") for k, v in docs.items()] + [(None, ITEM, "x", "y"), (1, docs[1], "x", "y")], "doc_id long, text string, h string, place string")
    got = contaminated(df, bench).collect()
    kinds = {(r.doc_id, r.item_id): r.kind for r in got}
    assert kinds == {(1, 1): "verbatim", (2, 1): "verbatim", (3, 1): "reparameterised", (4, 1): "verbatim", (8, 2): "verbatim", (None, 1): "verbatim"}
    assert sum(r.doc_id == 1 for r in got) == 2  # repeated rows are judged each
    kept = clean_documents(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6, 7, 9, 10]
    assert contaminated(no_docs, bench).count() == 0
    assert contaminated(df, bench.limit(0)).count() == 0


def test_items_without_windows(bench):
    assert {r.item_id for r in benchmark_windows(bench).select("item_id").collect()} == {1, 2}


def test_passages_of_the_tables_against_brute_force(spark, sf, documents):
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = {(d.doc_id, i) for d in documents.select("doc_id", "text").collect() for i, t in items.items() if t in plain(d.text)}
    got = {(r.doc_id, r.item_id) for r in contaminated(documents, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert want and got == want


def test_no_python_in_the_plan(spark, sf, documents):
    plan = contaminated(documents, spark.read.parquet(f"{sf}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow(?!Batch)", plan)
