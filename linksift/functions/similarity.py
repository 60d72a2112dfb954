"""Likeness of host labels to brand names: edit distance and Jaro-Winkler."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linksift.constants import (
    BRAND_DISTANCE_CAP,
    BRAND_LENGTH_BAND,
    BRANDS,
    MIN_BRAND_LABEL,
    NO_BRAND_DISTANCE,
)

_SHORTEST = max(MIN_BRAND_LABEL, min(map(len, BRANDS)) - BRAND_LENGTH_BAND)
_LONGEST = max(map(len, BRANDS)) + BRAND_LENGTH_BAND


def brand_distance(labels: Column, brands: tuple[str, ...] = BRANDS) -> Column:
    """Smallest edit distance from any label to any brand, 4 when above the cap.

    Labels shorter than three characters, and pairs whose lengths differ by more
    than three, do not count; 99 when no pair is left. The brand list is a fixed
    literal, so the pairs are made inside the row: no join and no shuffle.
    """
    span = BRAND_DISTANCE_CAP + 2

    def nearest(label: Column) -> Column:
        n = F.length(label)
        # levenshtein gives -1 above the cap; the remainder turns that into cap + 1
        return F.least(
            *[
                F.when(
                    (n >= len(b) - BRAND_LENGTH_BAND) & (n <= len(b) + BRAND_LENGTH_BAND),
                    (F.levenshtein(label, F.lit(b), BRAND_DISTANCE_CAP) + span) % span,
                )
                for b in brands
            ]
        )

    comparable = F.filter(labels, lambda l: (F.length(l) >= _SHORTEST) & (F.length(l) <= _LONGEST))
    nearest_of_all = F.array_min(F.transform(comparable, nearest))
    return F.when(labels.isNotNull(), F.coalesce(nearest_of_all.cast("double"), F.lit(NO_BRAND_DISTANCE)))


def _codes(words: list[str]) -> np.ndarray:
    return np.array([[ord(ch) for ch in w] for w in words], dtype=np.int32)


def jaro_winkler_block(left: list[str], right: list[str]) -> np.ndarray:
    """Jaro-Winkler of every left word (all of one length) with every right word (of one length).

    The prefix boost (at most four characters, 0.1 each) always applies.
    """
    a, b = _codes(left), _codes(right)
    la, lb = a.shape[1], b.shape[1]
    shape = (len(left), len(right))
    window = max(0, max(la, lb) // 2 - 1)
    equal = a[:, None, :, None] == b[None, :, None, :]
    used_a = np.zeros((*shape, la), dtype=bool)
    used_b = np.zeros((*shape, lb), dtype=bool)
    for i in range(la):
        free = np.ones(shape, dtype=bool)
        for j in range(max(0, i - window), min(i + window + 1, lb)):
            hit = free & equal[:, :, i, j] & ~used_b[:, :, j]
            used_b[:, :, j] |= hit
            free &= ~hit
        used_a[:, :, i] = ~free
    matches = used_a.sum(axis=2)
    # matched characters moved to the front, order kept, then compared place by place
    front_a = np.take_along_axis(
        np.broadcast_to(a[:, None, :], used_a.shape), np.argsort(~used_a, axis=2, kind="stable"), axis=2
    )
    front_b = np.take_along_axis(
        np.broadcast_to(b[None, :, :], used_b.shape), np.argsort(~used_b, axis=2, kind="stable"), axis=2
    )
    k = min(la, lb)
    in_match = np.arange(k)[None, None, :] < matches[:, :, None]
    swaps = ((front_a[:, :, :k] != front_b[:, :, :k]) & in_match).sum(axis=2) // 2
    m = np.maximum(matches, 1)
    jaro = np.where(matches > 0, (matches / la + matches / lb + (matches - swaps) / m) / 3, 0.0)
    p = min(4, la, lb)
    same = a[:, None, :p] == b[None, :, :p]
    prefix = np.cumprod(same, axis=2).sum(axis=2)
    return np.where(matches > 0, jaro + prefix * 0.1 * (1 - jaro), 0.0)


_BRANDS_BY_LENGTH: dict[int, list[str]] = {}
for _b in BRANDS:
    _BRANDS_BY_LENGTH.setdefault(len(_b), []).append(_b)


def best_brand_likeness(words: list[str]) -> np.ndarray:
    """Largest Jaro-Winkler of each word with a brand inside the length band; 0 if none."""
    best = np.zeros(len(words))
    by_length: dict[int, list[int]] = {}
    for pos, word in enumerate(words):
        if _SHORTEST <= len(word) <= _LONGEST:
            by_length.setdefault(len(word), []).append(pos)
    for n, positions in by_length.items():
        group = [words[p] for p in positions]
        for m, brands in _BRANDS_BY_LENGTH.items():
            if abs(n - m) <= BRAND_LENGTH_BAND:
                found = jaro_winkler_block(group, brands).max(axis=1)
                best[positions] = np.maximum(best[positions], found)
    return best


@F.arrow_udf(T.DoubleType())
def _likeness_arrow(hosts: pa.Array) -> pa.Array:
    """Per host: the best likeness over its labels, worked out once per distinct label of the batch."""
    parts = pc.split_pattern(hosts, ".")
    labels = pc.dictionary_encode(parts.flatten())
    if isinstance(labels, pa.ChunkedArray):
        labels = labels.combine_chunks()
    per_label = best_brand_likeness(labels.dictionary.to_pylist())
    values = per_label[labels.indices.to_numpy(zero_copy_only=False)] if len(labels) else np.zeros(0)
    owner = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    out = np.zeros(len(hosts))
    np.maximum.at(out, owner, values)
    return pa.array(out, pa.float64(), mask=pc.is_null(hosts).to_numpy(zero_copy_only=False))


def brand_likeness(host: Column) -> Column:
    """Largest Jaro-Winkler similarity between a label of ``host`` and a brand.

    Spark has no Jaro function, so this is an Arrow function. It is map-only:
    repeated labels ("com", "www") are folded per batch instead of through a
    shuffle, where such labels would be hot keys.
    """
    return _likeness_arrow(host)
