"""Seeded, stratified splits and folds by hash order, without a sort per class.

Two classes would mean two tasks if rows were numbered per class. Instead the
exact cut points of the hash order are found per class (order statistics), and
every row is placed by comparing its hash with them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linksift.operators.ranked import order_statistics



def hash_order(key: Sequence[str], seed: int) -> Column:
    """A number per row that depends on key and seed only (52 bits, exact as a double)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in key], F.lit(seed)), F.lit(2**52)).cast("double")


def with_part(df: DataFrame, key: Sequence[str], shares: Sequence[float], seed: int, name: str) -> DataFrame:
    """Add an INT column: which of the consecutive shares of its class's hash order a row is in."""
    h, label = hash_order(key, seed), F.col("label")
    columns = {0: F.when(label == 0, h), 1: F.when(label == 1, h)}
    bounds = [sum(shares[: i + 1]) for i in range(len(shares) - 1)]

    def ranks(n: Column) -> Column:
        entries = []
        for b in bounds:
            r = F.round(n * F.lit(b)).cast("long") - 1
            entries.append(
                F.struct(F.lit(b).alias("prob"), F.lit(0.0).alias("share"), r.alias("low"), r.alias("high"))
            )
        return F.array(*entries)

    hashed = df.select(*[c.alias(f"h{k}") for k, c in columns.items()])
    found = order_statistics(hashed, ["h0", "h1"], ranks).collect()
    cuts = {(r.feature, r.prob): r.value for r in found}

    def place(k: int) -> Column:
        return sum((F.when(h > cuts.get((f"h{k}", b), -1.0), 1).otherwise(0) for b in bounds), F.lit(0))

    return df.withColumn(name, F.when(label == 1, place(1)).otherwise(place(0)))


def stratified_split(df: DataFrame, key: Sequence[str], test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``part``: 'test' for the given share of each class, else 'train'."""
    parts = with_part(df, key, [test_size, 1 - test_size], seed, "_part")
    return parts.withColumn("part", F.when(F.col("_part") == 0, "test").otherwise("train")).drop("_part")


def stratified_folds(df: DataFrame, key: Sequence[str], k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1, of equal size within each class (up to one row)."""
    return with_part(df, key, [1 / k] * k, seed, "fold")


def half_split(df: DataFrame, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Add ``half``: 'calibrate' or 'evaluate'."""
    parts = with_part(df, key, [0.5, 0.5], seed, "_part")
    return parts.withColumn("half", F.when(F.col("_part") == 0, "calibrate").otherwise("evaluate")).drop("_part")
