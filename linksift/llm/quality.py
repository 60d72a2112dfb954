"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature has a lookup table over its bins; a few pairs of features have a table
over pairs of coarser bins. Cyclic boosting fits the tables: one shallow tree at a
time, on one feature or one pair, in turn, each adding a small step. A score is the
logistic of a sum of table cells, so scoring is bin search and addition in vectors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linksift.llm.common import text_or_empty

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "longest_word", "distinct_words", "repeated_neighbours", "alphabetic_words",
    "upper_words", "short_words", "upper_share", "digit_share", "symbol_share", "stop_share", "bar_share", "non_ascii_share",
    "line_bytes", "distinct_lines", "byte_entropy",
)
#: Most labelled rows that the model is fitted on, chosen by a hash of their ids.
FIT_ROWS = 20_000

_CLASSES = np.zeros((256, 7))
_CLASSES[65:91, 0] = 1  # upper
_CLASSES[97:123, 1] = 1  # lower
_CLASSES[48:58, 2] = 1  # digits
_CLASSES[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,;:'\"-?()"], 3] = 1  # symbols
_CLASSES[[ord(c) for c in ".,;:"], 4] = 1  # stops
_CLASSES[ord("|"), 5] = 1
_CLASSES[128:, 6] = 1


def features(text: str | None) -> list[float]:
    """The features of one whole text; a null or blank text has zeros."""
    raw = (text or "").encode("utf-8", "replace")
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower, digits, symbols, stops, bars, wide = (counts @ _CLASSES).tolist()
    share = counts[counts > 0] / len(raw)
    lines, n, lengths = text.split("\n"), len(words), list(map(len, words))
    return [
        np.log1p(len(raw)), np.log1p(n), sum(lengths) / n, float(max(lengths)), len(set(words)) / n, sum(map(eq, words, words[1:])) / n,
        sum(map(str.isalpha, words)) / n, sum(map(str.isupper, words)) / n, sum(k <= 3 for k in lengths) / n, upper / (upper + lower + 1),
        digits / len(raw), symbols / len(raw), stops / len(raw), bars / len(raw), wide / len(raw), len(raw) / len(lines),
        len(set(lines)) / len(lines), float(-(share * np.log2(share)).sum()),
    ]


def feature_matrix(texts: Sequence[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))


@dataclass
class AdditiveModel:
    """Lookup tables. ``edges[f]`` are the upper bounds of the bins of feature f."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], "left")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            i = np.searchsorted(self.pair_edges[a], x[:, a], "left")
            total += table[i, np.searchsorted(self.pair_edges[b], x[:, b], "left")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1])) if len(values) else np.zeros(0)


def _cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins."""
    if len(g) < 2:
        return 0.0, 0
    lg, lh = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = lg**2 / (lh + ridge) + (g.sum() - lg) ** 2 / (h.sum() - lh + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    best = int(np.argmax(gain))
    return (float(gain[best]), best + 1) if gain[best] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int, ridge: float) -> np.ndarray:
    """Values of a tree over neighbouring bins: for each bin its leaf's Newton step."""
    gain, at = _cut(g, h, ridge) if depth else (0.0, 0)
    if not at:
        return np.full(len(g), g.sum() / (h.sum() + ridge))
    return np.concatenate((_tree(g[:at], h[:at], depth - 1, ridge), _tree(g[at:], h[at:], depth - 1, ridge)))


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """A cut of the first feature, then one cut of the second on either side: the gain over
    no cut and the values of all cells."""
    best, values = 0.0, np.zeros_like(g)
    whole = g.sum() ** 2 / (h.sum() + ridge)
    for at in range(1, len(g)):
        gain, parts = -whole, []
        for gs, hs in ((g[:at].sum(0), h[:at].sum(0)), (g[at:].sum(0), h[at:].sum(0))):
            own = gs.sum() ** 2 / (hs.sum() + ridge)
            gain += own + _cut(gs, hs, ridge)[0]
            parts.append((gs, hs))
        if gain > best:
            best = gain
            rows = [_tree(gs, hs, 1, ridge) for gs, hs in parts]
            values = np.concatenate((np.tile(rows[0], (at, 1)), np.tile(rows[1], (len(g) - at, 1))))
    return best, values


def fit_tables(
    x: np.ndarray, y: np.ndarray, bins: int = 32, pair_bins: int = 8, n_pairs: int = 6, rounds: int = 120, pair_rounds: int = 40, rate: float = 0.1, ridge: float = 2.0
) -> AdditiveModel:
    """Boost the feature tables in turn, then choose the pairs that explain most of what
    is left and boost theirs. Without both labels the model is the (smoothed) base rate."""
    base = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(float(np.log(base / (1 - base))))
    width = x.shape[1]
    model.edges = [_edges(x[:, f], bins) for f in range(width)]
    model.pair_edges = [_edges(x[:, f], pair_bins) for f in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if len(np.unique(y)) < 2:
        return model
    at = [np.searchsorted(model.edges[f], x[:, f], "left") for f in range(width)]
    total = np.full(len(y), model.intercept)

    def sums(cell: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return np.bincount(cell, y - p, cells), np.bincount(cell, p * (1 - p), cells)

    for _ in range(rounds):
        for f in range(width):
            step = rate * _tree(*sums(at[f], len(model.tables[f])), depth=2, ridge=ridge)
            model.tables[f] += step
            total += step[at[f]]
    coarse = [np.searchsorted(model.pair_edges[f], x[:, f], "left") for f in range(width)]
    sizes = [len(e) + 1 for e in model.pair_edges]
    cell = {(a, b): coarse[a] * sizes[b] + coarse[b] for a, b in combinations(range(width), 2)}

    def pair_step(a: int, b: int) -> tuple[float, np.ndarray]:
        g, h = sums(cell[a, b], sizes[a] * sizes[b])
        return _pair_tree(g.reshape(sizes[a], sizes[b]), h.reshape(sizes[a], sizes[b]), ridge)

    gains = sorted(((-pair_step(a, b)[0], (a, b)) for a, b in cell))
    model.pairs = [pair for gain, pair in gains[:n_pairs] if gain < 0]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            step = rate * pair_step(a, b)[1]
            model.pair_tables[k] += step
            total += step.reshape(-1)[cell[a, b]]
    return model


def remainder(key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5: 0 is held out."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> AdditiveModel:
    """Fit on at most ``fit_rows`` labelled documents that are not held out.

    The sample is the pairs of id and label with the smallest hashes of their ids. They are few
    enough to be broadcast, so the documents are read once; features are worked out where the
    texts lie, and nothing else leaves the tasks. Null labels and ids, and labels of no
    document, take no part. An id counts once for each of its labels, however often it stands
    in either table; of several texts the one with the smallest features counts, so the
    sample doesn't depend on the order of tasks.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(remainder() != 0)
    known = known.withColumn("quality", (F.col("quality") > 0).cast("int")).distinct()
    n = known.count()
    order = F.xxhash64("doc_id")
    if n > 2 * fit_rows:  # a hash threshold, so that no task sends more than its share to the sample
        known = known.filter(F.pmod(order, F.lit(1 << 20)) < int(1.2 * fit_rows / n * (1 << 20)) + 64)
    sample = known.orderBy(order, "doc_id", "quality").limit(fit_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = pd.DataFrame(feature_matrix(b["text"]), columns=list(FEATURES))
            yield out.assign(y=(b["quality"].to_numpy() > 0).astype(float), doc_id=b["doc_id"].to_numpy())

    chosen = texts.join(F.broadcast(sample), "doc_id")
    held = chosen.mapInPandas(rows, ", ".join(f"{f} double" for f in (*FEATURES, "y")) + ", doc_id long")
    got = held.groupBy("doc_id", "y").agg(F.min(F.struct(*FEATURES)).alias("f")).select("doc_id", "y", "f.*").toPandas()
    got = got.sort_values(["doc_id", "y", *FEATURES])
    return fit_tables(got[list(FEATURES)].to_numpy(float), got["y"].to_numpy(float))


def score_column(model: AdditiveModel, text: str = "text") -> Column:
    """The score of each whole text, from 0 to 1; higher: the label 1 is likelier."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(feature_matrix(texts)))

    return score(text_or_empty(text))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 from the threshold on)."""
    model = fit(docs, labels, fit_rows)
    scored = docs.select(F.col("doc_id"), score_column(model).alias("score"))
    return scored.select(
        "doc_id", F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents, with all their columns, whose score reaches the threshold."""
    return docs.filter(score_column(fit(docs, labels, fit_rows)) >= threshold)
