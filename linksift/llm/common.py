"""Reading tables, stage tables in the shared folder, and tokenizer files."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linksift.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; it goes when the driver's JVM ends."""
    path = shared_folder(spark, f"llm-{name}-{uuid.uuid4().hex[:12]}")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).deleteOnExit(target)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: later readers neither
    work them out again nor depend on executors that may be lost."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer file; operators take any other path as well."""
    import public_tokenizers

    return public_tokenizers.path(name)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


#: A key is heavy if it has one of so many rows or more; there can be no more heavy keys than that.
HEAVY = 100_000


def spread_join(left: DataFrame, right: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join with a table of one row a key, in which ``size`` is (a bound from above of) the
    number of rows of ``left`` with that key, of ``total`` in all. Heavy keys are broadcast, at most
    ``HEAVY`` of them whatever the input; the others are joined by key, none of them hot."""
    heavy_from = F.col(size) * HEAVY >= F.lit(total)
    heavy, light = right.filter(heavy_from), right.filter(~heavy_from)
    few = F.broadcast(heavy)
    rest = left.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return left.join(few, key).unionByName(rest.join(light, key))
