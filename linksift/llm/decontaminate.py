"""Benchmark decontamination by canonical templates, in DataFrame operations only.

Texts of documents and benchmark items are brought into a canonical form: numbers,
units after numbers, and names become typed placeholders, letters are lower-cased and
punctuation goes. Windows of canonical words are joined by their hashes, and beside
them windows of plain lower-cased words, in which names stand as they are: a copy in
other case, or with other sentence ends, is told by these. Along each alignment the words behind the placeholders (slots) must map consistently: a value of
the item to the document's value that stands for it most often, or to itself; a window
in which it goes elsewhere is not counted, the others of the alignment are. So a question asked
again with other names and numbers is found, while a text that only has the same
frame with mixed-up values is not.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linksift.llm.common import text_or_empty, written

WINDOW = 8
SHORT_WINDOW = 4
COVERED = 0.5
#: Words of an item in one run that count however long the item is.
RUN = 13
#: Windows of the benchmark up to which they are sent to all tasks; beyond, both sides are shuffled.
BROADCAST_WINDOWS = 1_000_000

UNITS = (
    "kg", "g", "mg", "lbs?", "pounds?", "ounces?", "km", "m", "cm", "mm", "miles?", "feet", "foot", "inch(?:es)?", "yards?", "met(?:er|re)s?",
    "kilomet(?:er|re)s?", "l", "ml", "lit(?:er|re)s?", "gallons?", "s", "secs?", "seconds?", "min", "mins", "minutes?", "h", "hrs?", "hours?", "days?", "weeks?",
    "months?", "years?", "percent", "dollars?", "euros?", "cents?", "degrees?", "kmh", "mph",
)
#: A word with a capital and small letters, wherever it stands: at a sentence start it may be an
#: ordinary word, but then its slot holds the same value on both sides.
NAME = r"(?=\p{Lu})(?<![\p{L}0-9])\p{Lu}\p{Ll}\p{L}*"  # the cheap look at the letter comes first
NUMBER = r"[0-9]+(?:[.,:][0-9]+)*"
WORD_END = r"[^0-9\p{L}·]+"
UNIT = r"(?i)0[^0-9\p{L}·]*(?:" + "|".join(UNITS) + r")(?![\p{L}0-9·])"


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("·"), F.lit(" "))  # translate looks every character up


def _typed(text: Column) -> Column:
    """0 for a number and xunitx for a unit, in the text's own case."""
    typed = F.regexp_replace(F.regexp_replace(_plain(text), NUMBER, "0"), UNIT, "0 xunitx")
    return F.regexp_replace(typed, r"[0-9](?=\p{L})", "$0 ")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), WORD_END), "")


def canonical_words(text: Column) -> Column:
    """Words with placeholders: 0 for a number, xunitx for a unit, xnamex for a name."""
    return _words(F.regexp_replace(_typed(text), NAME, "xnamex"))


def plain_words(text: Column) -> Column:
    """The same places without names, so in any case of letters alike."""
    return _words(_typed(text))


def raw_words(text: Column) -> Column:
    """The words that stand behind the canonical ones, place by place, lower-cased."""
    joined = F.regexp_replace(_plain(text), r"(?<=[0-9])[.,:](?=[0-9])", "·")
    return _words(F.regexp_replace(joined, r"[0-9](?=\p{L})", "$0 "))


def _windows(df: DataFrame, words: str, width: int, hashes: str = "hashes") -> DataFrame:
    """Column ``hashes``: one for each place of ``words``, over the ``width`` (a power of two)
    words from there; the last ones hold less and equal no full window."""
    df = df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    step = 1
    # readers take the _outer generators: for the others the optimizer derives a filter on the
    # array's size, pushes it down to the text and so works the hashes out many times over
    while step < width:
        # pair each hash with that of the words that follow, until a window is full
        df = df.withColumn(hashes, F.zip_with(hashes, F.slice(hashes, F.lit(step + 1), F.greatest(F.size(hashes), F.lit(1))), lambda a, b: F.xxhash64(a, b)))
        step *= 2
    return df


PLACEHOLDERS = ("0", "xunitx", "xnamex")


def _bare(df: DataFrame, words: str, width: int, name: str) -> DataFrame:
    """Column ``name``: for each place of ``words`` whether more than three quarters of the window
    from there are placeholders."""
    df = df.withColumn(name, F.transform(words, lambda w: w.isin(*PLACEHOLDERS).cast("int")))
    step = 1
    while step < width:
        df = df.withColumn(name, F.zip_with(name, F.slice(name, F.lit(step + 1), F.greatest(F.size(name), F.lit(1))), lambda a, b: a + F.coalesce(b, F.lit(0))))
        step *= 2
    return df.withColumn(name, F.transform(name, lambda n: n * 4 > width * 3))


def _keyed_windows(df: DataFrame, width: int, kinds: dict[str, str]) -> DataFrame:
    """For each words column of ``kinds`` an array with the key of each window: the hash of its words or,
    in a window of hardly anything but placeholders, of the words ``r`` that stand behind
    them. All runs of numbers look alike otherwise, and each would meet each."""
    df = _windows(df, "r", width, "exact")
    for words, name in kinds.items():
        df = _bare(_windows(df, words, width, name), words, width, "bare")
        key = lambda x: F.when(x["bare"], F.xxhash64(F.lit("exact"), x["exact"])).otherwise(x[name])  # noqa: B023, E731
        df = df.withColumn(name, F.transform(F.arrays_zip(name, "exact", "bare"), key)).drop("bare")
    return df.drop("exact")


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, width, n_windows, at, h, key, canon, raw: the windows of each item, with the
    words of each. ``h`` is the hash of the words, ``key`` that by which windows are joined (see
    ``_keyed_windows``). Items of fewer than ``WINDOW`` words have windows of ``SHORT_WINDOW``;
    those with fewer words still can't be told from ordinary prose and have none."""
    words = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text")).distinct().select(
        "item_id", canonical_words(F.col("text")).alias("c"), plain_words(F.col("text")).alias("p"), raw_words(F.col("text")).alias("r")
    )
    parts = []
    for width, fits in ((WINDOW, F.size("c") >= WINDOW), (SHORT_WINDOW, F.size("c").between(SHORT_WINDOW, WINDOW - 1))):
        n = F.size("c") - width + 1
        for kind in ("c", "p"):
            held = _keyed_windows(_windows(words.filter(fits), kind, width), width, {kind: "keys"}).withColumn("n_windows", n)
            both = F.slice(F.arrays_zip("hashes", "keys"), F.lit(1), F.col("n_windows"))
            held = held.select("item_id", "n_windows", kind, "r", F.posexplode_outer(both).alias("at", "b"))
            parts.append(
                held.select(
                    "item_id", F.lit(width).alias("width"), "n_windows", "at", F.col("b.hashes").alias("h"), F.col("b.keys").alias("key"),
                    F.slice(kind, F.col("at") + 1, F.lit(width)).alias("canon"), F.slice("r", F.col("at") + 1, F.lit(width)).alias("raw"),
                )
            )
    return reduce(DataFrame.union, parts).distinct()


def matching_windows(
    texts: DataFrame, windows: DataFrame, width: int, sent: Callable[[DataFrame], DataFrame] = F.broadcast
) -> DataFrame:
    """(text_key, place) and the columns of each window of an item that stands at this place of the text."""
    words = texts.withColumn("c", canonical_words(F.col("text"))).withColumn("p", plain_words(F.col("text"))).withColumn("r", raw_words(F.col("text")))
    keyed = _keyed_windows(words, width, {"c": "named", "p": "lower"})
    places = keyed.select("text_key", F.posexplode_outer(F.arrays_zip("named", "lower")).alias("place", "b"))
    places = places.select("text_key", "place", F.explode_outer(F.array_distinct(F.array("b.named", "b.lower"))).alias("key"))
    return places.join(sent(windows), "key")


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, covered: float = COVERED) -> DataFrame:
    """(text_key, item_id, n_windows, n_covered, kind) for each distinct text and each item
    of which it holds enough windows, or a run of ``RUN`` words. kind: verbatim or reparameterised."""
    bench = written(benchmark_windows(benchmark), "benchmark-windows")
    n = bench.count()
    sent = (lambda df: F.broadcast(df)) if n <= BROADCAST_WINDOWS else (lambda df: df)
    widths = [WINDOW] + ([SHORT_WINDOW] if bench.filter(F.col("width") == SHORT_WINDOW).limit(1).count() else [])
    known = bench.select("width", "h").distinct()
    keyed = docs.select(F.md5(text_or_empty()).alias("text_key"), text_or_empty().alias("text"))

    def hashed(texts: DataFrame, width: int) -> DataFrame:
        texts = texts.withColumn("c", canonical_words(F.col("text"))).withColumn("p", plain_words(F.col("text")))
        return _windows(_windows(texts, "c", width, "named"), "p", width, "lower")

    hit = None
    for width in widths:
        places = hashed(keyed, width).select("text_key", F.explode_outer(F.array_union("named", "lower")).alias("h"))
        own = places.join(sent(known.filter(F.col("width") == width).select("h")), "h", "left_semi").select("text_key")
        hit = own if hit is None else hit.union(own)
    hit = written(hit.distinct(), "hit-texts")
    texts = written(keyed.join(hit, "text_key", "left_semi").dropDuplicates(["text_key"]), "hit-words")

    found = None
    for width in widths:
        own = matching_windows(texts, bench.filter(F.col("width") == width), width, sent)
        found = own if found is None else found.unionByName(own)
    found = written(found, "hit-windows")
    places = found.groupBy("text_key").agg(F.collect_set(F.struct("place", "width")).alias("places"))
    words = texts.join(places, "text_key").withColumn("r", raw_words(F.col("text")))
    own = F.transform("places", lambda p: F.struct(p["place"].alias("place"), p["width"].alias("width"), F.slice("r", p["place"] + 1, p["width"]).alias("own")))
    words = words.select("text_key", F.explode(own).alias("p"))
    pairs = found.join(words.select("text_key", "p.place", "p.width", "p.own"), ["text_key", "place", "width"])
    # the slots of a window: (place in the item, value in the item, value in the document) where the canonical word is a placeholder
    slots = F.filter(F.arrays_zip(F.sequence("at", F.col("at") + F.col("width") - 1).alias("i"), "canon", "raw", "own"), lambda x: x["canon"] != x["raw"])
    pairs = pairs.withColumn("slots", F.transform(slots, lambda x: F.struct(x["i"].alias("i"), x["raw"].alias("item"), x["own"].alias("doc"))))
    aligned = pairs.groupBy("text_key", "item_id", "width", "n_windows", (F.col("place") - F.col("at")).alias("shift")).agg(
        F.collect_set(F.struct("at", "slots")).alias("held")
    )
    # each value of the item goes with the document's value that stands for it at most places; of equally frequent
    # ones with the unchanged one. Only windows that say otherwise are dropped
    counted = F.array_distinct(F.flatten(F.transform("held", lambda w: w["slots"])))
    # written step by step: the optimizer would put each list's expression wherever the list is read, also inside loops
    aligned = written(aligned.withColumn("all", counted), "alignments")
    votes = F.transform(
        F.array_distinct(F.transform("all", lambda s: F.struct(s["item"].alias("item"), s["doc"].alias("doc")))),
        lambda v: F.struct(
            v["item"].alias("item"), F.size(F.filter("all", lambda s: (s["item"] == v["item"]) & (s["doc"] == v["doc"]))).alias("n"),
            (v["item"] == v["doc"]).alias("same"), v["doc"].alias("doc"),
        ),
    )
    aligned = written(aligned.withColumn("votes", votes).drop("all"), "alignment-votes")
    first = F.filter("votes", lambda v: ~F.exists("votes", lambda o: (o["item"] == v["item"]) & (F.struct(o["n"], o["same"], o["doc"]) > F.struct(v["n"], v["same"], v["doc"]))))
    aligned = aligned.withColumn("first", F.transform(first, lambda v: F.struct(v["item"].alias("item"), v["doc"].alias("doc"))))
    aligned = written(aligned.drop("votes"), "alignment-values")
    agrees = lambda s: (s["item"] == s["doc"]) | F.array_contains("first", F.struct(s["item"].alias("item"), s["doc"].alias("doc")))
    differs = lambda w: F.exists(w["slots"], lambda s: s["item"] != s["doc"])
    # other values in a window of hardly anything but placeholders, as in tables of numbers and lists of names, say nothing
    telling = lambda w: ~differs(w) | (F.size(w["slots"]) * 4 <= F.col("width") * 3)
    aligned = aligned.withColumn("held", F.filter("held", lambda w: F.forall(w["slots"], agrees) & telling(w)))
    aligned = aligned.withColumn("ats", F.array_sort(F.array_distinct(F.transform("held", lambda w: w["at"]))))
    aligned = written(aligned.drop("first").filter(F.size("ats") > 0), "alignment-windows")
    changed = F.exists("held", differs)
    # places in a row keep their distance to their numbers in the sorted list
    rows = F.transform("ats", lambda at, i: at - i)
    longest = F.array_max(F.transform(F.array_distinct(rows), lambda g: F.size(F.filter(rows, lambda r: r == g))))
    whole = aligned.groupBy("text_key", "item_id", "width", "n_windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("n_covered"), F.max(changed).alias("changed"),
        F.max(longest + F.col("width") - 1).alias("run"),
    )
    due = F.when(F.col("width") == WINDOW, F.lit(covered) * F.col("n_windows")).otherwise(F.col("n_windows"))
    return whole.filter((F.col("n_covered") >= due) | (F.col("run") >= RUN)).select(
        "text_key", "item_id", "n_windows", "n_covered", F.when(F.col("changed"), "reparameterised").otherwise("verbatim").alias("kind")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, covered: float = COVERED) -> DataFrame:
    """doc_id, item_id, n_windows, n_covered, kind: a row for each contaminated document and
    item. Texts are looked at once however many documents have them. Null and empty
    texts, and an empty benchmark, give no row; null ids keep their rows; other columns
    are not read."""
    texts = written(contaminated_texts(docs, benchmark, covered), "contaminated")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text_or_empty()).alias("text_key"))
    return ids.join(texts, "text_key").drop("text_key")


def clean_documents(docs: DataFrame, benchmark: DataFrame, covered: float = COVERED) -> DataFrame:
    """The documents, with all their columns, that hold no benchmark item."""
    bad = written(contaminated_texts(docs, benchmark, covered).select("text_key").distinct(), "contaminated")
    return docs.join(bad, F.md5(text_or_empty()) == F.col("text_key"), "left_anti")
