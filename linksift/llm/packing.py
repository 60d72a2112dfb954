"""Token ids as fixed-width packed bits, in blocks that can be read at random.

A part holds the ids of one range of document ids, in ascending order. Its blocks
are rows of a Parquet table in shared storage::

    part int      number of the range
    first long    ids of the part that stand before this block
    bits int      width of an id: the fewest bits that hold the vocabulary
    n_ids long    ids in the block
    doc_ids, doc_lens   the documents of the block and their numbers of ids
    payload binary      n_ids * bits bits, little end first, filled to a whole byte

Id number i of a block starts at bit i * bits of its payload, so any run of ids
unpacks with numpy without touching what stands before it.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linksift.llm.common import text_or_empty, written

BLOCK_IDS = 1 << 16
#: Stands for a piece that begins or ends with white space; ids have fewer bits, so none look like it.
ODD = b"\xff\xff\xff"
#: Marks that a byte-level pre-tokenizer keeps together behind a word.
MARKS = ".,;:!?*$%&#@+=~^|/\\\")]}_-"
BLOCK_SCHEMA = "part int, first long, bits int, n_ids long, doc_ids array<long>, doc_lens array<long>, payload binary"
READ_SCHEMA = "part int, doc_id long, first long, n_tokens long, ids_crc32 long"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """The ids, each in so many bits, little end first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    wide = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(wide[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, n: int, start: int = 0) -> np.ndarray:
    """Ids number start to start + n of a payload."""
    lo, hi = start * bits, (start + n) * bits
    raw = np.frombuffer(payload, np.uint8, (hi + 7) // 8 - lo // 8, lo // 8)
    if bits in (8, 16, 32):
        return raw.view(f"<u{bits // 8}").astype("<u4")
    flat = np.unpackbits(raw, bitorder="little")[lo % 8 : lo % 8 + n * bits]
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = flat.reshape(n, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes stand
    for themselves, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Words(dict):
    """The ids of words, worked out when first asked for.

    What has been used since the table was last half full stays, so frequent words are never
    lost, and there are never more than ``limit`` of them.
    """

    def __init__(self, find: Callable[[str], bytes], limit: int):
        super().__init__()
        self.find, self.limit, self.before = find, limit, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.find(word)
        if 2 * len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        self[word] = ids
        return ids


class WordCache:
    """Encodes whole texts with a byte-level tokenizer, each distinct word once.

    Byte-level pre-tokenizers end a word before any single blank that stands between
    two other characters, so the ids of a text are those of its pieces cut there. Inside
    a piece they end a word of letters before a mark and after it, and take the last
    character of a run of other white space by itself. So letters go to the library's model as
    one word, marks and white space are looked up, and what is none of these (numbers, letters
    mixed with marks, added tokens) goes to the library as it stands. Texts with other runs
    of white space are cut at safe blanks only. ``limit`` bounds the memory.
    """

    SAFE = re.compile(r"(?<=\S) (?=\S)")
    RUN = re.compile(r"([\t-\r]+)")

    def __init__(self, path: str, limit: int = 1_000_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.vocabulary = self.tok.get_vocab_size(with_added_tokens=True)
        # other pre-tokenizers may end words elsewhere: their texts go to the library whole
        self.by_word = isinstance(self.tok.pre_tokenizer, pre_tokenizers.ByteLevel) and self.tok.normalizer is None and not self.tok.pre_tokenizer.add_prefix_space
        self.letters, self.model = byte_letters(), self.tok.model
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.inside = Words(lambda w: self.find(w, " "), limit)
        self.first = Words(lambda w: self.find(w, ""), limit // 4)
        self.marks = Words(self.library, limit // 16)

    def library(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def find(self, word: str, blank: str) -> bytes:
        """Ids of a word with or without the blank before it; ``ODD`` if white space is at an end."""
        if not word or word[0].isspace() or word[-1].isspace():
            return ODD
        core = word.rstrip(MARKS)
        if core.isalpha():
            if len(core) < len(word):
                return (self.inside if blank else self.first)[core] + self.marks[word[len(core) :]]
            raw = core if core.isascii() else "".join([self.letters[b] for b in core.encode()])
            found = [t.id for t in self.model.tokenize((self.letters[32] if blank else "") + raw)]
            return struct.pack(f"<{len(found)}I", *found)
        parts = self.RUN.split(word)
        if len(parts) == 1 or any(t in word for t in self.added):  # added tokens cut a text before anything else
            return self.library(blank + word)
        out = [self.inside[parts[0]] if blank else self.first[parts[0]]]
        for run, part in zip(parts[1::2], parts[2::2]):
            out += [self.marks[run[:-1]] if len(run) > 1 else b"", self.marks[run[-1]], self.first[part]]
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids, as little-endian unsigned 32-bit integers."""
        if not self.by_word:
            return [self.library(t) for t in texts]
        out, look = [], self.inside.__getitem__
        for text in texts:
            head, *rest = text.split(" ")
            ids = self.first[head] + b"".join(map(look, rest))
            out.append(self.by_safe_blanks(text) if ODD in ids else ids)
        return out

    def by_safe_blanks(self, text: str) -> bytes:
        """A text with special white space, cut at blanks that stand between other characters only."""
        head, *rest = self.SAFE.split(text)
        parts = [self.library(head) if head else b""]
        for piece in rest:
            ids = ODD if " " in piece else self.inside[piece]
            parts.append(self.library(" " + piece) if ODD in ids else ids)
        return b"".join(parts)


_encoders: dict[str, WordCache] = {}


def encoder(path: str) -> WordCache:
    """The encoder of this Python worker; its cache serves all tasks that the worker runs."""
    if path not in _encoders:
        _encoders[path] = WordCache(path)
    return _encoders[path]


def write_packed(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> None:
    """Encode whole texts, end each with ``end_id`` and write the blocks below ``path``.

    Rows are dealt out by ranges of the key (null first) and sorted inside them: one
    shuffle, no single task. A null text counts as empty and gives the end id alone.
    Rows with the same key are ordered by text. Other columns are not read. A block
    holds whole documents and ends when it has ``BLOCK_IDS`` ids; a longer document
    makes a longer block.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, first = encoder(tokenizer), TaskContext.get().partitionId(), 0
        bits, end = bits_for(max(enc.vocabulary, end_id + 1)), np.array([end_id], "<u4").tobytes()
        ids, lens, raw, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal first, ids, lens, raw, held
            flat = np.frombuffer(b"".join(raw), "<u4")
            row = [[part], [first], [bits], [len(flat)], [ids], [lens], [pack(flat, bits)]]
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            first, ids, lens, raw, held = first + len(flat), [], [], [], 0
            names = ["part", "first", "bits", "n_ids", "doc_ids", "doc_lens", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                keys, texts = some.column(0).to_pylist(), some.column(1).to_pylist()
                for k, x in zip(keys, enc.encode(texts)):
                    ids.append(k)
                    lens.append(len(x) // 4 + 1)
                    raw += (x, end)
                    held += lens[-1]
                    if held >= BLOCK_IDS:
                        yield block()
        if ids:
            yield block()

    ranged.mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(path)


def read_packed(docs_path: str, spark) -> DataFrame:
    """Per document of the files: part, first (ids before it in the part), n_tokens and
    the crc32 of its ids as little-endian unsigned 32-bit integers."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, first, bits, n, keys, lens, payload = (batch.column(c)[i] for c in range(7))
                ids = unpack(payload.as_buffer(), bits.as_py(), n.as_py()).tobytes()
                sizes = np.array(lens.as_py(), np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * len(crc), pa.int32()), keys.values, pa.array(starts + first.as_py()), pa.array(sizes), pa.array(crc, pa.int64())],
                    ["part", "doc_id", "first", "n_tokens", "ids_crc32"],
                )

    return spark.read.schema(BLOCK_SCHEMA).parquet(docs_path).mapInArrow(check, READ_SCHEMA)


def read_ids(spark, path: str, part: int, start: int, n: int) -> np.ndarray:
    """Ids number start to start + n of a part: only the blocks that hold them are read."""
    hit = spark.read.schema(BLOCK_SCHEMA).parquet(path).filter(
        (F.col("part") == part) & (F.col("first") < start + n) & (F.col("first") + F.col("n_ids") > start)
    )
    out = []
    for r in hit.select("first", "bits", "n_ids", "payload").orderBy("first").toLocalIterator():
        a, b = max(0, start - r["first"]), min(r["n_ids"], start + n - r["first"])
        out.append(unpack(r["payload"], r["bits"], b - a, a))
    return np.concatenate(out) if out else np.zeros(0, "<u4")


def part_offsets(per_doc: DataFrame) -> DataFrame:
    """One row per part: the ids of all parts before it. There are as many rows as ranges."""
    total = per_doc.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return total.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("before"))


def token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the files and read them back: doc_id, start, n_tokens, ids_crc32."""
    write_packed(docs, path, tokenizer, end_id)
    per_doc = written(read_packed(path, docs.sparkSession), "packed-docs")
    return per_doc.join(part_offsets(per_doc), "part").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
