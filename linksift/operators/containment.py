"""Which of many strings stand in which texts: an inverted index over rare character grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linksift.functions.stages import staged
from linksift.session import written

GRAM = 4
#: A gram is heavy with one of so many gram places or more, so there are never more heavy grams than that.
HEAVY = 10_000
#: The places of a heavy gram are dealt to so many slices.
SLICES = 64


def _grams(chars: Column, size: Column | int, width: int) -> Column:
    """Hashes of all runs of ``width`` characters; equal hashes are checked later, on the texts."""
    runs = F.transform(chars, lambda _, i: F.xxhash64(*[F.get(chars, i + k) for k in range(width)]))
    return F.slice(runs, F.lit(1), F.greatest(size - (width - 1), F.lit(0)))


def containing(texts: DataFrame, entries: DataFrame) -> DataFrame:
    """(text, entry_id) for every distinct ``text`` and every entry (entry_id, needle) that it contains.

    Each entry is looked up by the one of its grams that the fewest texts hold; an entry
    shorter than a gram is its own gram. An entry with a gram that no text holds is out at
    once. Texts and entries meet by equal grams and are then compared in full. Grams
    that very many texts hold are dealt to slices. Null and empty needles stand in no text.
    """
    entries = written(entries.select("entry_id", "needle").filter("needle <> ''").distinct(), "needles")
    short = entries.filter(F.length("needle") < GRAM).select(F.length("needle").alias("n")).distinct().collect()
    widths = sorted({GRAM, *[r.n for r in short]})
    chars, size = F.col("_chars"), F.size("_chars")

    cut = staged(entries, _chars=F.split("needle", ""))
    own = F.when(size >= GRAM, _grams(chars, size, GRAM))
    for width in widths[:-1]:
        own = own.when(size == width, _grams(chars, size, width))
    wanted = written(cut.select("entry_id", "needle", F.explode(F.array_distinct(own)).alias("gram")), "needle-grams")

    spelled = staged(texts.select("text").distinct(), ("text",), _chars=F.split("text", ""))
    every = F.array_distinct(F.concat(*[_grams(chars, size, w) for w in widths]))
    places = spelled.select("text", F.explode(every).alias("gram"))
    counts = places.join(wanted.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    counts = written(counts, "gram-counts")
    heavy = counts.filter(F.col("n") * HEAVY >= (counts.agg(F.sum("n")).first()[0] or 0)).select("gram", F.lit(True).alias("heavy"))

    n = F.coalesce("n", F.lit(0))
    rarest = wanted.join(counts, "gram", "left").groupBy("entry_id", "needle").agg(F.min(F.struct(n.alias("n"), F.col("gram"))).alias("least"))
    keys = rarest.filter("least.n > 0").select("entry_id", "needle", "least.gram").join(F.broadcast(heavy), "gram", "left")
    every_slice = F.when(F.col("heavy"), F.sequence(F.lit(0), F.lit(SLICES - 1))).otherwise(F.array(F.lit(0)))
    keys = written(keys.select("gram", "entry_id", "needle", F.explode(every_slice).alias("slice")), "needle-keys")
    dealt = F.when(F.col("heavy"), F.pmod(F.xxhash64("text"), F.lit(SLICES))).otherwise(0).cast("int")
    places = places.join(F.broadcast(heavy), "gram", "left").select("text", "gram", dealt.alias("slice"))
    return places.join(keys, ["gram", "slice"]).filter(F.col("text").contains(F.col("needle"))).select("text", "entry_id")
