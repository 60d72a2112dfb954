"""Where the columns of a stage are worked out."""

from __future__ import annotations

from pyspark.sql import functions as F

from linksift.functions.stages import staged
from linksift.functions.urlparts import searchable


def test_stage_columns_are_worked_out_below_the_generator(spark):
    df = staged(spark.createDataFrame([(1, "a"), (2, None)], "id int, s string"), ["id"], up=F.upper("s"), n=F.length("s"))
    assert df.columns == ["id", "up", "n"]
    assert sorted(map(tuple, df.collect())) == [(1, "A", 1), (2, None, None)]
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    generator = [line for line in lines if "Generate inline" in line]
    assert len(generator) == 1 and "upper" not in generator[0] and "length" not in generator[0]
    assert any("Project" in line and "upper" in line for line in lines)


def test_stage_may_replace_a_column(spark):
    df = staged(spark.createDataFrame([(1, "a")], "id int, s string"), ["id"], s=F.concat("s", F.lit("b")))
    assert df.columns == ["id", "s"] and df.first()["s"] == "ab"


def test_tabs_and_line_ends_go_without_a_table_of_characters(spark):
    df = spark.createDataFrame([("\x01 ht\ttp://a\r\n/b\n",), ("",), (None,)], "u string").select(searchable(F.col("u")).alias("u"))
    assert [r[0] for r in df.collect()] == ["http://a/b", "", None]
    assert "translate" not in df._jdf.queryExecution().optimizedPlan().toString()
