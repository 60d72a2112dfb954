"""Phrase collocation mining by dynamic itemset counting.

The corpus is cut into a few shards that are scanned in a cycle. Phrases of all lengths
are counted in the same scan. A longer phrase is activated as soon as both of its
subphrases (without its last word, without its first one) have reached the threshold in
what has been scanned so far, and is counted until it has seen each shard once, one full cycle.
So most long phrases are counted while shorter ones still are, and no scan counts
phrases of one length alone. When no phrase is left in its cycle, every phrase over the
threshold has its exact count: its subphrases are at least as frequent, so they
reached the threshold at some step.

Which phrases have reached it is told to the tasks as a bitmap (a Bloom filter) of a
fixed number of bits, however many they are. A phrase counts as active from the step at which
the bitmap holds both subphrases; bitmaps only grow, and all tasks have the same one,
so the phrase is counted in exactly the steps t to t + shards - 1, whether the bitmap was
right or not. A false hit costs the count of a phrase that stays below the threshold; it
changes no count.

The corpus is cut into words once: a shard's rows are blocks of a few megabytes of text of one
language, as the block's distinct words and their numbers in order, both compressed: Spark
hands a task's blocks to Python in one batch. Grams of a block are
numbered exactly, as a pair of the number of their first words and their last word.
Between tasks a phrase travels as 128 bits of hashes of its language and words, with the number of
one block that holds it; a last step spells each phrase that reached the threshold in that block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linksift.llm.common import fresh_path, text_or_empty, written

LEAST, LONGEST, TOP, KEPT_PERCENT = 100, 5, 2000, 100
SHARDS = 3
#: Bits of the bitmap of phrases over the threshold; the size of what is broadcast, whatever the input.
FILTER_BITS = 1 << 25
PROBES, CHUNK_BITS = 4, 1 << 16
#: Characters of text whose words are numbered together.
BLOCK = 1 << 22
#: Parts of a language's phrases that are ranked by themselves before their first ones are ranked together.
PARTS = 64
#: In ``first`` of a phrase, the bits of a block's number; the step stands above them.
BLOCK_BITS = 40
#: Bits of a phrase's hash mixed into the number of its block, so that the least one is dealt evenly.
DEAL = (1 << 16) - 1
STOPS = ".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + STOPS.encode(), b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(STOPS))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _scramble(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    """Two 64-bit hashes of each word in a language."""
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(w, seed) for w in words]), "<u8").reshape(-1, 2)


def longer_hash(gram: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of their first words and those of their last word."""
    with np.errstate(over="ignore"):
        return _scramble(gram * _MIX + last)


def _place(h: np.ndarray, probe: int, bits: int) -> np.ndarray:
    """The bit of each hash for one of the probes."""
    with np.errstate(over="ignore"):
        return (h + np.uint64(probe) * (_scramble(h ^ _MIX) | np.uint64(1)) if probe else h) % np.uint64(bits)


def holds(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the bitmap may hold each hash; never false for one that was put in."""
    found = np.ones(len(h), bool)
    left = np.arange(len(h))
    for i in range(PROBES):  # most that are not in it go at the first probe
        at = _place(h[left], i, 8 * len(bitmap))
        hit = (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        found[left[~hit]] = False
        left = left[hit]
    return found


def tokens(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of some texts, and their numbers in order (-1 between pieces)."""
    raw = "\n".join(texts).encode("utf-8", "surrogatepass").translate(_TABLE).replace(b"\n", b" \n ")
    split = pc.split_pattern(pa.array([raw], pa.large_binary()), b" ").values.dictionary_encode()
    number, words = split.indices.to_numpy(), split.dictionary.to_pylist()
    new = np.full(len(words), -1, np.int32)
    kept = np.array([w not in (b"", b"\n") for w in words], bool)
    new[kept] = np.arange(kept.sum())
    blank = words.index(b"") if b"" in words else -1
    return [w for w in words if w not in (b"", b"\n")], new[number[number != blank]]


def packed(data: bytes) -> bytes:
    """The data compressed, after its length in eight bytes."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(memoryview(data)[8:], size, codec="zstd", asbytes=True) if size else b""


def block_number(task: int, nth: int) -> int:
    """The number of a task's nth block; the low bits that ``DEAL`` mixes tell 16 blocks of 4,096 tasks apart."""
    if task >= 1 << 20 or nth >= 1 << 20:
        raise ValueError(f"more than a million tasks or blocks of a task: {task}, {nth}")
    return (nth >> 4) << 24 | task << 4 | nth & 15


def coded_blocks(docs: DataFrame, shards: int) -> DataFrame:
    """shard, block (its number), lang, words (parted by blanks) and numbers (32-bit integers), both
    packed, and n (words in all) of each block."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("text")).filter("text <> ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = {}
        size: dict[str, int] = {}
        task, made = TaskContext.get().partitionId(), 0

        def block(lang: str) -> pa.RecordBatch:
            nonlocal made
            size.pop(lang)
            words, number = tokens(held.pop(lang))
            made += 1
            row = [pa.array([(task + made) % shards], pa.int32()), pa.array([block_number(task, made - 1)], pa.int64()), pa.array([lang], pa.string())]
            row += [pa.array([packed(b" ".join(words))], pa.binary()), pa.array([packed(number.astype("<i4").tobytes())], pa.binary()), pa.array([int((number >= 0).sum())], pa.int64())]
            del words, number
            pa.default_memory_pool().release_unused()  # what splitting took; the worker goes on to scan
            return pa.RecordBatch.from_arrays(row, ["shard", "block", "lang", "words", "numbers", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                for lang, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    held.setdefault(lang, []).append(text)
                    size[lang] = size.get(lang, 0) + len(text)
                    if size[lang] >= BLOCK:
                        yield block(lang)
                    elif sum(size.values()) >= 4 * BLOCK:  # many languages at once
                        yield block(max(size, key=size.get))
        for lang in list(held):
            yield block(lang)

    return rows.mapInArrow(run, "shard int, block long, lang string, words binary, numbers binary, n long")


def _whole(h: np.ndarray) -> pa.Array:
    """Pairs of hashes as values of 16 bytes."""
    return pa.Array.from_buffers(pa.binary(16), len(h), [None, pa.py_buffer(np.ascontiguousarray(h))])


class Grams:
    """The grams of one block whose subphrases are in the bitmap ``now``.

    ``old`` is the bitmap a full cycle earlier: what it activates has been counted everywhere.
    """

    def __init__(self, lang: str, words: bytes, numbers: bytes, now: np.ndarray | None, old: np.ndarray | None):
        self.words = words.split(b" ") if words else []
        self.number = np.frombuffer(numbers, "<i4").astype(np.int64)
        self.inside = self.number >= 0
        self.of_word = word_hashes(self.words, lang)
        self.now, self.old = now, old

    def counted_words(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and counts of all words; no subphrase need be frequent for them."""
        return self.of_word, np.bincount(self.number[self.inside], minlength=len(self.words))

    def levels(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray, np.ndarray]]:
        """For each length from 2 on: hashes and counts of the grams to be counted, and
        the length, hashes and a place of each gram of that length that the bitmap holds."""
        n, size = len(self.number), len(self.words)
        if self.now is None or not size:
            return

        def in_old(h: np.ndarray) -> np.ndarray:
            return holds(self.old, h[:, 0]) if self.old is not None else np.zeros(len(h), bool)

        # by place: does a frequent gram of the present length begin here, and which
        frequent, done, gram, hashes = np.zeros(n, bool), np.zeros(n, bool), self.number, self.of_word
        frequent[self.inside] = holds(self.now, hashes[:, 0])[self.number[self.inside]]
        done[self.inside] = in_old(hashes)[self.number[self.inside]]
        for length in range(2, longest + 1):
            at = np.flatnonzero(frequent[:-1] & frequent[1:])  # a place between pieces is never frequent
            if not len(at):
                return
            last = self.number[at + length - 1]
            key = gram[at] * size + last
            due, f = np.unique(key[~(done[at] & done[at + 1])], return_counts=True)
            counted = longer_hash(hashes[due // size], self.of_word[due % size])
            in_now = holds(self.now, longer_hash(hashes[gram[at], 0], self.of_word[last, 0]))
            at, key = at[in_now], key[in_now]
            distinct, first, of = np.unique(key, return_index=True, return_inverse=True)
            hashes = longer_hash(hashes[distinct // size], self.of_word[distinct % size])
            yield counted, f, length, hashes, at[first]
            frequent, done, gram = np.zeros(n, bool), np.zeros(n, bool), np.full(n, -1, np.int64)
            frequent[at], done[at], gram[at] = True, in_old(hashes)[of], of

    def places(self, wanted: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """A place and the length of each wanted phrase, told by its hashes; -1 for one that is not here."""
        place, size = np.full(len(wanted), -1), np.full(len(wanted), -1)
        known = _whole(wanted)
        near = np.zeros(1 << 16, bool)  # most phrases of the block are not wanted
        near[(wanted[:, 0] & np.uint64(0xFFFF)).astype(np.int64)] = True
        at = np.flatnonzero(self.inside)
        gram = self.of_word[self.number[at]]
        for length in range(1, longest + 1):
            if length > 1:
                on = at + length - 1 < len(self.number)
                on[on] = self.inside[at[on] + length - 1]
                at = at[on]
                gram = longer_hash(gram[on], self.of_word[self.number[at + length - 1]])
            hit = np.flatnonzero(near[(gram[:, 0] & np.uint64(0xFFFF)).astype(np.int64)])
            which = pc.index_in(_whole(gram[hit]), value_set=known)
            hit, which = hit[pc.is_valid(which).to_numpy(zero_copy_only=False)], which.drop_null().to_numpy()
            place[which], size[which] = at[hit], length
        return place, size

    def spelled(self, place: np.ndarray, length: int) -> list[bytes]:
        return [b" ".join([self.words[i] for i in self.number[p : p + length].tolist()]) for p in place.tolist()]


def scan(shard: DataFrame, sent: Broadcast, longest: int, words_too: bool, step: int) -> DataFrame:
    """h1, h2, f (occurrences in a block) and first (the step, and the block's number mixed with h1)
    of all active phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, old = sent.value
        for batch in batches:
            for row in range(batch.num_rows):
                number, lang, words, numbers = (batch.column(c)[row].as_py() for c in ("block", "lang", "words", "numbers"))
                block = Grams(lang, unpacked(words), unpacked(numbers), now, old)
                for h, f in [block.counted_words()] * words_too + [level[:2] for level in block.levels(longest)]:
                    for at in range(0, len(f), 100_000):
                        two = h[at : at + 100_000].view(np.int64)
                        first = np.int64(step << BLOCK_BITS | number) ^ (two[:, 0] & DEAL)
                        yield pa.RecordBatch.from_arrays([pa.array(two[:, 0]), pa.array(two[:, 1]), pa.array(f[at : at + 100_000], pa.int64()), pa.array(first)], ["h1", "h2", "f", "first"])

    return shard.select("block", "lang", "words", "numbers").mapInArrow(run, "h1 long, h2 long, f long, first long")


def spell(counts: DataFrame, blocks: DataFrame, longest: int) -> DataFrame:
    """lang, phrase, f of the counted phrases (block, h1, h2, f), each spelled once, in its block."""

    def run(wanted: pa.Table, block: pa.Table) -> pa.Table:
        if not wanted.num_rows:
            return pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.string()), "f": pa.array([], pa.int64())})
        lang, words, numbers = (block[c][0].as_py() for c in ("lang", "words", "numbers"))
        whole = Grams(lang, unpacked(words), unpacked(numbers), None, None)
        place, size = whole.places(np.column_stack([wanted[c].to_numpy() for c in ("h1", "h2")]).view(np.uint64), longest)
        if (place < 0).any():
            raise ValueError(f"{(place < 0).sum()} phrases are not in the block they were counted in")
        phrases = [whole.spelled(place[i : i + 1], k)[0] for i, k in enumerate(size.tolist())]
        return pa.table({"lang": pa.array([lang] * len(phrases), pa.string()), "phrase": pa.array(phrases, pa.binary()).cast(pa.string()), "f": wanted["f"]})

    texts = blocks.select("block", "lang", "words", "numbers")
    return counts.groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(run, "lang string, phrase string, f long")


def put(bitmap: np.ndarray | None, phrases: DataFrame, bits: int) -> np.ndarray | None:
    """The bitmap with some phrases (their h1) put in. Their bits are set on the executors; the
    driver gets pieces of the bitmap, at most its own size."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            at = np.unique(np.concatenate([_place(h, i, bits) for i in range(PROBES)])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // CHUNK_BITS), pa.array(at % CHUNK_BITS)], ["chunk", "bit"])

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        flat = np.zeros(CHUNK_BITS, np.uint8)
        flat[rows["bit"].to_numpy()] = 1
        return pd.DataFrame({"chunk": [key[0]], "bits": [np.packbits(flat, bitorder="little").tobytes()]})

    found = phrases.mapInArrow(hashed, "chunk long, bit long").groupBy("chunk").applyInPandas(packed, "chunk long, bits binary").collect()
    if not found:
        return bitmap
    grown = np.zeros(bits // 8, np.uint8) if bitmap is None else bitmap.copy()
    for r in found:
        at = r["chunk"] * (CHUNK_BITS // 8)
        grown[at : at + CHUNK_BITS // 8] |= np.frombuffer(r["bits"], np.uint8)
    return grown


def _same(a: np.ndarray | None, b: np.ndarray | None) -> bool:
    return a is b or (a is not None and b is not None and np.array_equal(a, b))


def counted(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """The blocks, and h1, h2, f and block (one that holds it) of all phrases over the threshold."""
    if bits % CHUNK_BITS:
        raise ValueError(f"the number of bits must be a multiple of {CHUNK_BITS}")
    spark: SparkSession = docs.sparkSession
    path = fresh_path(spark, "phrase-shards")
    coded_blocks(docs, shards).write.partitionBy("shard").parquet(path)
    blocks = spark.read.schema("block long, lang string, words binary, numbers binary, n long, shard int").parquet(path)

    bitmaps: list[np.ndarray | None] = [None]  # before this step and the ones a cycle back
    state: DataFrame | None = None
    step = 0
    while step < shards or not _same(bitmaps[-1], bitmaps[0]):
        now, old = bitmaps[-1], bitmaps[0] if step >= shards else None
        sent = spark.sparkContext.broadcast((now, old))
        found = scan(blocks.filter(F.col("shard") == step % shards), sent, longest, step < shards, step)
        found = found.select("h1", "h2", "f", "first", F.lit(False).alias("known"))
        if state is not None:
            # phrases whose cycle is over stay only if they reached the threshold
            held = state.filter((F.shiftright("first", BLOCK_BITS) > step - shards) | (F.col("f") >= least)).withColumn("known", F.col("f") >= least)
            found = held.union(found)
        merged = found.groupBy("h1", "h2").agg(F.sum("f").alias("f"), F.min("first").alias("first"), F.max("known").alias("known"))
        state = written(merged, f"phrases-{step}")
        sent.destroy()
        bitmaps = [*bitmaps, put(now, state.filter((F.col("f") >= least) & ~F.col("known")).select("h1"), bits)][-shards - 1 :]
        step += 1
    block = F.col("first").bitwiseAND((1 << BLOCK_BITS) - 1).bitwiseXOR(F.col("h1").bitwiseAND(DEAL))
    return blocks, state.filter(F.col("f") >= least).select(block.alias("block"), "h1", "h2", "f")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, bits: int = FILTER_BITS) -> DataFrame:
    """lang, phrase, f of all phrases of 1 to ``longest`` words that occur ``least`` times or more
    in a language, with their exact counts, and the number of all words as phrase ""."""
    blocks, counts = counted(docs, least, longest, shards, bits)
    total = blocks.groupBy("lang").agg(F.sum("n").alias("f")).filter("f > 0").select("lang", F.lit("").alias("phrase"), "f")
    return spell(counts, blocks, longest).union(total)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, percent: int = KEPT_PERCENT, **how: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases of two words or more.

    A phrase is scored by its weakest cut: floor(1000 * a * n / (l * r)) with a, l and r the
    counts of the phrase and of its two parts and n the number of all words; of equal cuts the
    first. A phrase that stands inside a longer one with ``percent`` per cent of its count
    is left out. Arithmetic is in whole numbers of 38 digits. A null language counts as
    ``und``, a null text as an empty one; every row counts, repeated ones too. Columns other than
    doc_id, lang and text are not read. An empty table gives an empty one.
    """
    return scored(written(frequent_phrases(docs, least, longest, **how), "frequent-phrases"), top, percent)


def ranked_first(phrases: DataFrame, top: int, *keys: str | Column) -> DataFrame:
    """The first ``top`` phrases of each key, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return phrases.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def first_of_parts(phrases: DataFrame, top: int, parts: int = PARTS) -> DataFrame:
    """A language's phrases without those that are not among the first ``top`` of their part: what is
    left is at most parts * top rows a language, whatever the input."""
    return ranked_first(phrases, top, "lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).drop("rank")


def scored(known: DataFrame, top: int, percent: int) -> DataFrame:
    """Phrases ranked by their weakest cuts, from the counts (lang, phrase, f)."""
    total = known.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    known = known.filter("phrase <> ''")
    candidates = known.withColumn("w", F.split("phrase", " ")).withColumn("k", F.size("w")).filter("k >= 2")

    def part(at, size):
        return F.array_join(F.slice("w", at, size), " ")

    cut = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cut = cut.select("lang", "phrase", F.col("f").alias("a"), "cut", part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail"))
    left = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cuts = cut.join(left, ["lang", "head"]).join(right, ["lang", "tail"]).join(F.broadcast(total), "lang")
    big = {c: F.col(c).cast("decimal(19,0)") for c in "anlr"}
    cuts = cuts.withColumn("over", F.lit(1000).cast("decimal(4,0)") * big["a"] * big["n"]).withColumn("under", big["l"] * big["r"]).withColumn("score", F.expr("over div under"))
    weakest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best")).select("lang", "phrase", "best.*")

    # the most frequent longer phrase around each phrase
    spans = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda size: F.transform(F.sequence(F.lit(1), F.col("k") - size + 1), lambda at: part(at, size)))))
    around = candidates.filter("k >= 3").select("lang", spans.alias("phrase"), F.col("f").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    hundred, share = F.lit(100).cast("decimal(3,0)"), F.lit(percent).cast("decimal(10,0)")
    inside = F.col("longer").isNotNull() & (hundred * F.col("longer").cast("decimal(19,0)") >= share * big["a"])
    free = weakest.join(around, ["lang", "phrase"], "left").filter(~inside)
    ranked = ranked_first(first_of_parts(free, top), top, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = LEAST, longest: int = LONGEST, top: int = TOP, percent: int = KEPT_PERCENT) -> str:
    stops = "".join(c if c >= " " else f"\\x{ord(c):02x}" for c in STOPS)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[{stops}]')) AS piece
      FROM documents
    ), worded AS (
      SELECT lang, list_filter(string_split(replace(piece, chr(9), ' '), ' '), lambda w: w <> '') AS w FROM pieces
    ), totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM worded GROUP BY lang
    ), starts AS (
      SELECT lang, w, unnest(range(1, len(w) + 1)) AS p FROM worded WHERE len(w) > 0
    ), grams AS (
      SELECT lang, array_to_string(w[p:p + k - 1], ' ') AS phrase, k FROM starts, (SELECT unnest(range(1, {longest} + 1)) AS k)
      WHERE p + k - 1 <= len(w)
    ), known AS (
      SELECT lang, phrase, k, count(*)::HUGEINT AS f, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, phrase, k HAVING count(*) >= {least}
    ), cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM known WHERE k >= 2
    ), scored AS (
      SELECT c.lang, c.phrase, c.k, c.cut, c.f AS a, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.f * n) // (x.f * y.f) AS score
      FROM cuts c JOIN known x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
        JOIN known y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')
        JOIN totals t ON t.lang = c.lang
    ), weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
    ), sizes AS (SELECT *, unnest(range(2, k)) AS size FROM known WHERE k >= 3
    ), spans AS (SELECT *, unnest(range(1, k - size + 2)) AS p FROM sizes
    ), around AS (SELECT lang, array_to_string(w[p:p + size - 1], ' ') AS phrase, max(f) AS longer FROM spans GROUP BY 1, 2
    ), free AS (
      SELECT w.* FROM weakest w LEFT JOIN around o ON o.lang = w.lang AND o.phrase = w.phrase
      WHERE o.longer IS NULL OR 100 * o.longer < {percent} * w.a
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
      a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
    FROM free QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {top}
    """
