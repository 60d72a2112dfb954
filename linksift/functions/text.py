"""Column functions on text: cleaning, counting, entropy, substring sets."""

from __future__ import annotations

import functools
import operator
import math
from collections.abc import Iterable, Iterator
from encodings.idna import ToUnicode
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character that counts as whitespace when trimming.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Control characters and blank, dropped at the left of a URL.
C0_AND_BLANK = "".join(chr(i) for i in range(33))
# Characters with a digit value (decimal digits, then the digit
# forms that compatibility normalisation leaves alone).
DIGIT_CLASS = (
    r"\p{Nd}\x{1369}-\x{1371}\x{19DA}\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}"
    r"\x{2780}-\x{2788}\x{278A}-\x{2792}\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}"
    r"\x{11052}-\x{1105A}"
)


def strip(c: Column) -> Column:
    """Drop whitespace at both ends (all Unicode whitespace, not blanks only)."""
    return F.trim(c, F.lit(WHITESPACE))


def is_ascii(c: Column) -> Column:
    """True where every character takes one byte in UTF-8."""
    return F.octet_length(c) == F.char_length(c)


@F.arrow_udf(T.StringType())
def _compatible(texts: pa.Array) -> pa.Array:
    """The composed compatibility form (Arrow's own function does not compose)."""
    distinct = texts.dictionary_encode()
    forms = pa.array([t if t is None else normalize("NFKC", t) for t in distinct.dictionary.to_pylist()], pa.string())
    return forms.take(distinct.indices)


def normalise(c: Column) -> Column:
    """NFKC, NFC, then drop control, format, private and unassigned characters.

    Spark has no Unicode normaliser, so rows that are not ASCII cross to Arrow; ASCII
    rows are sent as NULL, which costs one validity bit each. The characters are
    dropped in the JVM.
    """
    ascii_only = is_ascii(c)
    text = F.when(ascii_only, c).otherwise(_compatible(F.when(~ascii_only, c)))
    return F.regexp_replace(text, r"[\p{C}&&[^\t\n\r]]", "")


def _readable(label: str) -> str:
    """One host label; a coded one that is no valid code stays as it is."""
    try:
        return ToUnicode(label) if label.startswith("xn--") else label
    except UnicodeError:
        return label


@F.arrow_udf(T.StringType())
def _idna_arrow(hosts: pa.Array) -> pa.Array:
    labels = pc.split_pattern(hosts.cast(pa.string()), ".")
    coded = labels.flatten().dictionary_encode()
    plain = pa.array([_readable(label) for label in coded.dictionary.to_pylist()], pa.string())
    ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(labels), 0))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends.cast(pa.int32())])
    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, plain.take(coded.indices)), ".")
    return pc.if_else(hosts.is_null(), pa.scalar(None, pa.string()), joined)


def punycode_decoded(host: Column) -> Column:
    """The readable form of an ``xn--`` host; other hosts pass unchanged in the JVM."""
    coded = host.contains("xn--")
    return F.when(coded, _idna_arrow(F.when(coded, host))).otherwise(host)


def count_of(c: Column, char: str) -> Column:
    """How often one character occurs."""
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def without_blanks(parts: Column) -> Column:
    """Array without its empty strings."""
    return F.array_remove(parts, "")


def shannon(c: Column) -> Column:
    """Shannon entropy in bits over the characters of a string; 0 for an empty one.

    Sorting the characters turns equal ones into runs, so one pass over the runs
    gives all counts: H = log2(n) - sum(k * log2(k)) / n.
    """
    in_order = F.array_join(F.sort_array(F.split(c, "")), "")
    runs = F.regexp_extract_all(in_order, F.lit(r"(?s)(.)\1*"), F.lit(0))
    n = F.length(c)
    weighted = F.aggregate(
        runs, F.lit(0.0), lambda acc, run: acc + F.length(run) * F.log2(F.length(run).cast("double"))
    )
    return F.when(n <= 1, F.when(n.isNotNull(), F.lit(0.0))).otherwise(
        F.greatest(F.lit(0.0), F.log2(n.cast("double")) - weighted / n)
    )


def _log2(numbers: np.ndarray) -> np.ndarray:
    """The quotient of logarithms that Spark takes, once per distinct number."""
    distinct, at = np.unique(numbers, return_inverse=True)
    return np.array([math.log(x) / math.log(2) for x in distinct], np.float64)[at]


def entropies(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What ``shannon`` gives, for texts that lie end to end in UTF-8."""
    rows, width = len(ends), 128
    if len(data) and data.max() >= width:
        # the code points of characters, numbered through
        first = (data & 0xC0) != 0x80
        ends = np.append(0, np.cumsum(first))[ends]
        points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        known, data = np.unique(points, return_inverse=True)
        width = len(known)
    n = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(rows), n)
    counts = np.bincount(owner * width + data, minlength=rows * width)
    found = np.flatnonzero(counts)
    k = counts[found]
    weighted = np.bincount(found // width, weights=k * _log2(k), minlength=rows)
    n = np.maximum(n, 1)
    return np.maximum(0.0, _log2(n) - weighted / n)


@F.arrow_udf(T.DoubleType())
def _entropy_arrow(texts: pa.Array) -> pa.Array:
    parts = [entropies(data, ends) for data, ends in pieces_of(texts)]
    return pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64(), mask=texts.is_null().to_numpy(zero_copy_only=False))


def entropy(c: Column) -> Column:
    """``shannon`` of short texts, worked out over Arrow for a batch at once: no string is made for each run.

    Several calls in one projection travel together. Long texts belong to ``shannon``, since a batch holds thousands.
    """
    return F.coalesce(_entropy_arrow(c), F.lit(0.0))


#: Bytes of text that an Arrow function takes apart at once.
PIECE_BYTES = 500_000


def pieces_of(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The UTF-8 bytes of some texts laid end to end, and where each text ends, until all had their turn."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + PIECE_BYTES, side="right")) - 1)
        hi = min(hi, len(texts), lo + 4_096)
        yield data[ends[lo] : ends[hi]], ends[lo + 1 : hi + 1] - ends[lo]
        lo = hi


def contains_any(c: Column, needles: Iterable[str]) -> Column:
    """True where at least one of a fixed, small set of strings is a substring."""
    return functools.reduce(operator.or_, [c.contains(n) for n in needles])


def contained(c: Column, needles: Iterable[str]) -> Column:
    """The sorted array of those strings of a fixed, small set found in ``c``.

    The hits are joined and split again, which stays in generated code; none of
    the strings may hold a comma.
    """
    hits = F.concat_ws(",", *[F.when(c.contains(n), F.lit(n)) for n in sorted(needles)])
    return without_blanks(F.split(hits, ","))
