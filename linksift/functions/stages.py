"""Keeping the stages of a long projection apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def staged(df: DataFrame, keep: list[str] | tuple[str, ...] = ("*",), **columns: Column) -> DataFrame:
    """The kept columns and the given ones, which end a stage.

    The new columns come out of a generator of one element. A later filter on one of
    them stays above it: the optimizer would otherwise rewrite the filter over the raw
    text and copy all expressions on the way into it, several times where one refers
    to another more than once. Filters on columns that are only carried pass below, down
    to the scan and its partitions.

    The generator only hands the columns on: they are worked out in a projection below it, in
    compiled code that works out common parts once, which a generator's own arguments are not.
    """
    made = df.select(*keep, *[c.alias(f"_made_{name}") for name, c in columns.items()])
    # names, as the kept columns may be "*" or expressions
    kept = [c for c in made.columns if c not in {f"_made_{name}" for name in columns}]
    return made.select(*kept, F.inline(F.array(F.struct(*[F.col(f"_made_{name}").alias(name) for name in columns]))))
