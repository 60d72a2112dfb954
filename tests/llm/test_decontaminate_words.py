"""Words of texts with numbers, units and names; looking characters up one by one is not needed for them."""

from __future__ import annotations

from pyspark.sql import functions as F

from linksift.llm.decontaminate import canonical_words, plain_words, raw_words


def test_numbers_units_names_and_middle_dots(spark):
    text = "A·b 12.5kg of Ärzte3Mal, 100 km (7)days 3,5x 20 Kgs iOS O'Brien 0m²"
    row = spark.createDataFrame([(text,)], "text string").select(*[f("text").alias(n) for n, f in (("c", canonical_words), ("p", plain_words), ("r", raw_words))])
    plan = row._jdf.queryExecution().optimizedPlan().toString()
    got = row.first()
    assert got.c == ["a", "b", "0", "xunitx", "of", "xnamex0", "xnamex", "0", "xunitx", "0", "xunitx", "0", "x", "0", "xnamex", "ios", "o", "xnamex", "0", "xunitx"]
    assert got.p == ["a", "b", "0", "xunitx", "of", "ärzte0", "mal", "0", "xunitx", "0", "xunitx", "0", "x", "0", "kgs", "ios", "o", "brien", "0", "xunitx"]
    assert got.r == ["a", "b", "12·5", "kg", "of", "ärzte3", "mal", "100", "km", "7", "days", "3·5", "x", "20", "kgs", "ios", "o", "brien", "0", "m"]
    assert "translate" not in plan
