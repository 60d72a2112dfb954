"""Token counts of fields and sections, from one encoding of the whole document.

Encoding each section by itself gives other tokens than the document has, and
encodes overlapping fields twice. Here a document is encoded once; the byte span of
every token follows from the widths of its tokens; spans of tokens and sections
are joined inside the document by binary search, and tokens that cross a boundary
are allocated by a stated rule.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linksift.llm.common import text_or_empty

RULES = ("most", "first", "share")
#: Section number of the tokens that touch no section.
OUTSIDE = -1
SPANS = "array<struct<start:int,end:int>>"
SCHEMA = "doc_id long, section int, start_char long, end_char long, n_tokens long, n_crossing long, share double"


class Widths:
    """A byte-level tokenizer of the tiktoken library and the bytes of each of its ids."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.width[i] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Byte offset of the end of each token of the text."""
        return np.cumsum(self.width[np.array(self.encoding.encode_ordinary(text), np.int64)]) if text else np.zeros(0, np.int64)


_tokenizers: dict[tuple[str, str], Widths] = {}


def widths(path: str, pattern: str) -> Widths:
    if (path, pattern) not in _tokenizers:
        _tokenizers[path, pattern] = Widths(path, pattern)
    return _tokenizers[path, pattern]


def line_spans(text: str) -> list[tuple[int, int]]:
    """Character spans of the lines that hold more than white space."""
    return [m.span() for m in re.finditer(r"[^\n]*\S[^\n]*", text)]


def disjoint(spans: Sequence[tuple[int, int]], length: int) -> list[tuple[int, int, int]]:
    """(start, end, number) in ascending order. Spans are cut to the text; of the
    characters that several spans hold, the one that starts first keeps them."""
    out, reached = [], 0
    for a, b, k in sorted((max(0, a), min(length, b), k) for k, (a, b) in enumerate(spans)):
        a = max(a, reached)
        if a < b:
            out.append((a, b, k))
            reached = b
    return out


def allocate(ends: np.ndarray, starts_of: np.ndarray, ends_of: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each section, and last for what lies outside: tokens under the rule, tokens
    that it shares with other sections, and the sum of its shares by bytes.

    ``starts_of`` and ``ends_of`` are ascending and disjoint. ``most``: the section with
    most of the token's bytes, the earlier of equals; ``first``: the first section that
    the token touches; ``share``: as ``most`` for whole numbers, while ``share`` divides
    each token by bytes. A token's bytes outside all sections count for no section
    unless it touches none at all.
    """
    n = len(starts_of)
    tokens, crossing, share = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64), np.zeros(n + 1)
    begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    lo = np.searchsorted(ends_of, begins, "right")
    hi = np.searchsorted(starts_of, ends, "left")
    touched = hi - lo
    one = np.bincount(lo[touched == 1], minlength=n + 1)
    tokens += one
    share += one
    outside = int((touched <= 0).sum())
    tokens[n] += outside
    share[n] += outside
    for i in np.flatnonzero(touched > 1).tolist():
        k = np.arange(lo[i], hi[i])
        held = np.minimum(ends_of[k], ends[i]) - np.maximum(starts_of[k], begins[i])
        share[k] += held / held.sum()
        crossing[k] += 1
        tokens[k[0] if rule == "first" else k[int(np.argmax(held))]] += 1
    return tokens, crossing, share


def attribute_tokens(docs: DataFrame, tokenizer: str, pattern: str, rule: str = "most", spans: str | None = None) -> DataFrame:
    """Tokens of each section of each document, by document and section number.

    ``spans`` names an array of (start, end) character spans; without it the sections
    are the lines. There is a row for each section, also one without tokens, and a row
    with section -1 where tokens touch none, so the rows of a document sum up to its
    tokens. A null text or null spans count as empty: such a document has no row.
    Other columns are not read; repeated rows are counted each. It is a projection:
    nothing is shuffled, and a document is held by one task at a time.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    given = F.col(spans).cast(SPANS) if spans else F.lit(None).cast(SPANS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), given.alias("spans"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = widths(tokenizer, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                keys, found = [], [[] for _ in range(6)]
                for key, text, own in zip(*(some.column(c).to_pylist() for c in range(3))):
                    cut = line_spans(text) if spans is None else [(s["start"], s["end"]) for s in own or () if s and None not in s.values()]
                    parts = disjoint(cut, len(text))
                    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
                    a, b, k = (np.array(x, np.int64) for x in (zip(*parts) if parts else ((), (), ())))
                    if len(raw) == len(text):
                        a_byte, b_byte = a, b
                    else:
                        byte_of = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
                        a_byte, b_byte = byte_of[a], byte_of[b]
                    tokens, crossing, share = allocate(tok.ends(text), a_byte, b_byte, rule)
                    m = len(k) + bool(tokens[-1])
                    keys += [key] * m
                    pad = [OUTSIDE] * (m - len(k))
                    for to, part in zip(found, (np.append(k, pad), np.append(a, pad), np.append(b, pad), tokens[:m], crossing[:m], share[:m])):
                        to.append(part)
                flat = [np.concatenate(x) if x else np.zeros(0) for x in found]
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                arrays = [pa.array(keys, pa.int64()), *(pa.array(x.astype(t.to_pandas_dtype())) for x, t in zip(flat, kinds))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing", "share"])

    return rows.mapInArrow(count, SCHEMA)


def rendered(records: DataFrame, fields: Sequence[str], separator: str = "\n") -> DataFrame:
    """The records with ``text``, their fields joined by the separator, and ``spans``, the
    character span of each field (null fields are empty)."""
    text, spans, at = [], [], F.lit(0)
    for i, name in enumerate(fields):
        part = text_or_empty(name)
        text.append(part)
        end = at + F.char_length(part)
        spans.append(F.struct(at.cast("int").alias("start"), end.cast("int").alias("end")))
        at = end + len(separator)
    return records.withColumns({"text": F.concat_ws(separator, *text), "spans": F.array(*spans)})
