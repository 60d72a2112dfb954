"""N-gram Jaccard join: groups of documents whose sets of word shingles overlap.

Two sets link when ``100 * intersection >= percent * union``. Documents with the same
set are one class; only classes are compared. The search is DivideSkip's, laid out
over tasks:

1. A first pass counts in how many documents each shingle occurs. Shingles of more
   than ``long_list`` documents have long inverted lists; there can only be so many of
   them, and they are few enough to be sent to all tasks.
2. A class of n shingles needs T = ceil(percent/100 * n) common ones. All but its
   n - T + l rarest lists are set aside, so a partner must occur on l of these
   (l = ``short_hits``, or T if smaller). Short lists are merged in the task that holds
   their range of hashes; pairs are counted over all ranges, and those below l go.
3. A class consisting mostly of common shingles has long lists among its rarest ones.
   Members of a long list are compared with its first member; then only those of
   still different groups are, block against block, once for all lists that share
   members. No pairs are listed for that.
4. Candidates are verified by DivideSkip on whole sets: in each task the
   shingles of a block of documents form inverted lists, the short ones are merged by
   a heap, the long ones probed by binary search, and what reaches the overlap stays.

Nothing is capped: an order of the shingles that is the same for all documents is
all that steps 2 and 3 need to lose no link, however the counts turn out.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linksift.llm.common import spread_join, text_or_empty, written
from linksift.llm.components import connected_components

WORDS = 5
PERCENT = 75
LONG_LIST = 32
SHORT_HITS = 3
#: Most shingles with long lists; where more would qualify, the least count is doubled.
MOST_LONG = 2_000_000
#: Shingles that a map task holds before it hands them on.
HELD = 1 << 22
QUERY_BLOCK, INDEX_BLOCK = 128, 512

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _scramble(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[9:14] = 32
_VALUE = _scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, n: int) -> np.ndarray:
    """The first n powers (modulo 2^64) of the base, or of its inverse."""
    if len(_powers[name]) < n:
        base = _BASE if name == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(2 * n, base, np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[name][:n]


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingles of a whole text as ascending 64-bit hashes.

    Words are runs of characters other than blank and 0x09-0x0D, with A-Z lower-cased.
    A text of fewer words is one shingle; one without words has none. A hash is a
    polynomial over the shingle's bytes with one blank between words, taken from
    running sums, then scrambled.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    flat = _LOWER[raw]
    solid = flat != 32
    if not solid.any():
        return np.zeros(0, np.uint64)
    solid_before = np.concatenate(([False], solid[:-1]))
    flat = flat[solid | solid_before]
    ends = np.flatnonzero(flat == 32)
    if flat[-1] != 32:
        ends = np.append(ends, len(flat))
    starts = np.concatenate(([0], ends[:-1] + 1))
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUE[flat] * _power("up", len(flat)), dtype=np.uint64)))
        a, b = (starts[: 1 - words or None], ends[words - 1 :]) if len(ends) >= words else (starts[:1], ends[-1:])
        return np.unique(_scramble((sums[b] - sums[a]) * _power("down", len(flat))[a]))


def class_of(tokens: np.ndarray) -> int:
    """A 64-bit name of a set of shingles."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def needed(n: int, percent: int = PERCENT) -> int:
    """Shingles that any partner must share with a set of n."""
    return -(-percent * n // 100)


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[str]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            yield from batch.slice(at, 500).column(column).to_pylist()


def classes(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and cid (the class; null for an empty set) of each document."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words) for t in _texts([batch], 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())],
                ["doc_id", "n_shingles", "cid"],
            )

    return docs.select("doc_id", "text").mapInArrow(name, "doc_id long, n_shingles long, cid long")


def _buckets(spark: SparkSession) -> int:
    """Bits of the number of hash ranges: a few for each shuffle partition."""
    return min(24, max(6, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()))


def long_shingles(docs: DataFrame, long_list: int, most: int, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, int]:
    """The shingles (cut to ``bits`` high bits) of more than ``long_list`` documents, their
    counts, and bits. Shingles that agree in so many bits are counted together, which
    is as good for an order. The counts go over all documents."""
    lead = _buckets(docs.sparkSession)
    bits = 32 + lead

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            flat = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
            part = (flat >> np.uint64(32)).astype(np.int64)
            names, at = np.unique(part, return_index=True)
            low = flat.astype("<u4")
            for k, a, b in zip(names.tolist(), at.tolist(), [*at[1:].tolist(), len(flat)]):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([low[a:b].tobytes()])], ["bucket", "low"])

        for text in _texts(batches, 0):
            tokens = shingles(text, words)
            if len(tokens) and (name := class_of(tokens)) not in seen:
                seen = seen if len(seen) < 500_000 else set()
                seen.add(name)
                held.append(tokens >> np.uint64(64 - bits))
                size += len(tokens)
                if size >= HELD:
                    yield from flush()
                    held, size = [], 0
        yield from flush()

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        low = np.sort(np.concatenate([np.frombuffer(x, "<u4") for x in rows["low"]]))
        at = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        df = np.diff(np.append(at, len(low)))
        hot = df > long_list
        return pd.DataFrame({"cut": (np.int64(key[0]) << 32) + low[at[hot]].astype(np.int64), "df": df[hot].astype(np.int64)})

    found = written(docs.select("text").mapInArrow(cut, "bucket long, low binary").groupBy("bucket").applyInPandas(count, "cut long, df long"), "long-shingles")
    least = long_list
    while found.filter(F.col("df") > least).count() > most:
        least *= 2
    got = found.filter(F.col("df") > least).toPandas().sort_values("cut")
    return got["cut"].to_numpy(np.uint64), got["df"].to_numpy(np.int64), bits


def _pairs_of_lists(token: np.ndarray, cid: np.ndarray, n: np.ndarray, percent: int) -> pd.DataFrame:
    """Pairs of classes of near enough sizes with the number of lists that both are on."""
    order = np.lexsort((cid, token))
    token, cid, n = token[order], cid[order], n[order]
    first = np.concatenate(([True], (token[1:] != token[:-1]) | (cid[1:] != cid[:-1])))
    token, cid, n = token[first], cid[first], n[first]
    pairs, step = [], 1
    while step < len(token):
        same = np.flatnonzero(token[step:] == token[:-step])
        if not len(same):
            break
        other = same + step
        fits = 100 * np.minimum(n[same], n[other]) >= percent * np.maximum(n[same], n[other])
        pairs.append(np.stack((cid[same[fits]], cid[other[fits]], n[same[fits]], n[other[fits]])))
        step += 1
    flat = np.concatenate(pairs, axis=1) if pairs else np.zeros((4, 0), np.int64)
    order = np.lexsort((flat[1], flat[0]))
    flat = flat[:, order]
    at = np.flatnonzero(np.concatenate((np.ones(min(1, flat.shape[1]), bool), (flat[:2, 1:] != flat[:2, :-1]).any(axis=0))))
    hits = np.diff(np.append(at, flat.shape[1]))
    return pd.DataFrame({"kind": 0, "a": flat[0, at], "b": flat[1, at], "n_a": flat[2, at], "n_b": flat[3, at], "hits": hits})


def postings(docs: DataFrame, long: tuple[np.ndarray, np.ndarray, int], percent: int, short_hits: int, words: int = WORDS) -> DataFrame:
    """kind 0: pairs of classes (a, b) with their hits on short lists, by range of hashes;
    kind 1: places on long lists, as shingle (a), class (b) and the millionths of its
    shingles whose lists are short (n_b)."""
    spark = docs.sparkSession
    lead = _buckets(spark)
    sent = spark.sparkContext.broadcast(long)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, df, bits = sent.value
        seen: set[int] = set()
        held, size = ([], [], [], []), 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not held[0]:
                return
            token, cid, n, far = (np.concatenate(x) for x in held)
            # a place on a long list is dealt out by its class: no list is whole in one task
            by = np.where(far, _scramble(cid.astype(np.uint64)), token) >> np.uint64(64 - lead)
            by = by.astype(np.int64) * 2 + far
            order = np.argsort(by, kind="stable")
            token, cid, n, by = token[order], cid[order], n[order], by[order]
            names, at = np.unique(by, return_index=True)
            for k, a, b in zip(names.tolist(), at.tolist(), [*at[1:].tolist(), len(by)]):
                blobs = [pa.array([x[a:b].tobytes()], pa.binary()) for x in (token, cid, n.astype("<u4"))]
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), *blobs], ["bucket", "token", "cid", "n"])

        for text in _texts(batches, 0):
            tokens = shingles(text, words)
            if not len(tokens) or (name := class_of(tokens)) in seen:
                continue
            seen = seen if len(seen) < 500_000 else set()
            seen.add(name)
            n, share = len(tokens), needed(len(tokens), percent)
            want = n - share + min(short_hits, share)
            if len(hot):
                cuts = tokens >> np.uint64(64 - bits)
                at = np.minimum(np.searchsorted(hot, cuts), len(hot) - 1)
                far = hot[at] == cuts
            else:
                far, at = np.zeros(n, bool), np.zeros(n, np.int64)
            chosen = tokens[~far][:want]
            more = want - len(chosen)
            if more > 0:
                common = tokens[far]
                chosen = np.concatenate((chosen, common[np.lexsort((common, df[at[far]]))][:more]))
            more = max(more, 0)
            held[0].append(chosen)
            held[1].append(np.full(len(chosen), name, np.int64))
            on_long = np.arange(len(chosen)) >= len(chosen) - more
            held[2].append(np.where(on_long, (~far).sum() * 1_000_000 // n, n))
            held[3].append(on_long)
            size += len(chosen)
            if size >= HELD // 2:
                yield from flush()
                held, size = ([], [], [], []), 0
        yield from flush()

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        token, cid, n = (np.concatenate([np.frombuffer(x, t) for x in rows[c]]) for c, t in (("token", "<u8"), ("cid", "<i8"), ("n", "<u4")))
        if key[0] % 2:
            return pd.DataFrame({"kind": 1, "a": token.view(np.int64), "b": cid, "n_a": 0, "n_b": n.astype(np.int64), "hits": 0})
        return _pairs_of_lists(token, cid, n.astype(np.int64), percent)

    shape = "bucket long, token binary, cid binary, n binary"
    return docs.select("text").mapInArrow(cut, shape).groupBy("bucket").applyInPandas(merge, "kind int, a long, b long, n_a long, n_b long, hits long")


def divide_skip(
    query: np.ndarray, lists: tuple[np.ndarray, np.ndarray], sizes: np.ndarray, percent: int, skip: Callable[[int], bool] = lambda m: False
) -> Iterator[int]:
    """Members of a block whose overlap with the query set is enough, but for those to skip.

    ``lists`` are the block's inverted lists: shingles, ascending, and members, ascending
    within a shingle. The longest lists are set aside; the short ones are merged by a
    heap; members that reach what can't come from the long lists alone are probed there.
    """
    shingle, member = lists
    lo, hi = np.searchsorted(shingle, query, "left"), np.searchsorted(shingle, query, "right")
    length = hi - lo
    share = needed(len(query), percent)
    if (length > 0).sum() < share:
        return
    most = int(length.max())
    aside = min(share - 1, int(share / (0.01 * np.log2(most + 1) + 1)))
    order = np.argsort(length, kind="stable")
    short, long = order[: len(order) - aside], order[len(order) - aside :]
    merged = heapq.merge(*(member[lo[i] : hi[i]].tolist() for i in short.tolist() if length[i]))
    # the place of (list, member) among all places of the long lists, for binary probes
    keys = np.concatenate([np.int64(k) * len(sizes) + member[lo[i] : hi[i]] for k, i in enumerate(long.tolist())]) if aside else np.zeros(0, np.int64)
    ranks = np.arange(aside, dtype=np.int64) * len(sizes)
    for m, run in groupby(merged):
        seen = sum(1 for _ in run)
        if seen < share - aside or skip(m):
            continue
        probe = ranks + m
        at = np.searchsorted(keys, probe)
        at[at == len(keys)] = 0
        both = seen + (int((keys[at] == probe).sum()) if len(keys) else 0)
        if 100 * both >= percent * (len(query) + int(sizes[m]) - both):
            yield m


def search(tasks: DataFrame, texts: DataFrame, percent: int, words: int = WORDS) -> DataFrame:
    """Links (a, b) found in ``tasks`` (task, side, cid, part): in each task, queries (side 1)
    against the block (side 0). Members with the query's own ``part`` are skipped."""

    def one(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        index, queries = [r for r in rows if r[1] == 0], [r for r in rows if r[1] == 1]
        if not index or not queries:
            return
        sets = [shingles(r[4], words) for r in index]
        flat, member = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(flat, kind="stable")
        sizes = np.array([len(s) for s in sets])
        for q in queries:
            # one link to each group will do: its other members are skipped from then on
            linked = {q[3]} if q[3] is not None else set()
            for m in divide_skip(shingles(q[4], words), (flat[order], member[order]), sizes, percent, lambda m: index[m][2] == q[2] or index[m][3] in linked):
                if index[m][3] is not None:
                    linked.add(index[m][3])
                yield q[2], index[m][2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 200):
                    yield from zip(*(c.to_pylist() for c in batch.slice(at, 200).columns))

        for _, group in groupby(rows(), key=lambda r: r[0]):
            if found := list(one(list(group))):
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    ready = tasks.join(texts, "cid").select("task", "side", "cid", "part", "text")
    return ready.repartition("task").sortWithinPartitions("task", "side", "cid").mapInArrow(run, "a long, b long")


def _pair_tasks(pairs: DataFrame, block: int = INDEX_BLOCK) -> DataFrame:
    """Each a as a query against blocks of its b's; an a with many is queried in many tasks."""
    size = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    dealt = pairs.join(size, "a").select("a", "b", F.xxhash64("a", F.pmod(F.xxhash64("b"), "blocks")).alias("task"))
    none = F.lit(None).cast("long").alias("part")
    return dealt.select("task", F.lit(0).alias("side"), F.col("b").alias("cid"), none).union(
        dealt.select("task", F.lit(1).alias("side"), F.col("a").alias("cid"), none).distinct()
    )


def _list_tasks(places: DataFrame, component: DataFrame) -> DataFrame:
    """Tasks for the members of long lists that are still in different groups.

    Only lists with members of two groups or more are looked at, and for their connections
    with one row for each (list, group), however many members of it are on the list. Groups
    that share such lists form a family, so that two members of many common lists meet in one
    task only. In each family the members outside its largest group are queries against all
    members on such lists, block by block.
    """
    part_of = component.withColumnsRenamed({"node": "cid", "component": "part"})
    on = written(places.join(part_of, "cid", "left").select("token", "cid", F.coalesce("part", "cid").alias("part")), "list-parts")
    open_lists = written(on.groupBy("token").agg(F.count(F.lit(1)).alias("places"), F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo <> hi").select("token", "places"), "open-lists")
    on = written(spread_join(on, open_lists, "token", "places", on.count()).select("token", "cid", "part"), "open-places")
    # a list's name is a shingle, a group's that of a class: told apart by a hash of either kind
    edges = on.select(F.xxhash64(F.lit("list"), "token").alias("a"), F.xxhash64(F.lit("group"), "part").alias("b"), "part").distinct()
    family = connected_components(edges).select(F.col("node").alias("b"), F.col("component").alias("family")).join(edges.select("b", "part").distinct(), "b")
    members = written(on.select("cid", "part").distinct().join(family.select("part", "family"), "part").select("cid", "family", "part"), "families")
    groups = members.groupBy("family", "part").agg(F.count(F.lit(1)).alias("k"))
    shape = groups.groupBy("family").agg(F.sum("k").alias("k"), F.max_by("part", F.struct("k", "part")).alias("main"), F.max("k").alias("main_k"))
    shape = shape.filter("k > main_k").select(
        "family", "main", F.ceil(F.col("k") / INDEX_BLOCK).cast("int").alias("ib"), F.ceil((F.col("k") - F.col("main_k")) / QUERY_BLOCK).cast("int").alias("qb")
    )
    held = members.join(shape, "family")
    index = held.withColumn("i", F.pmod(F.xxhash64("cid"), F.col("ib")).cast("int")).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("qb") - 1)))
    asked = held.filter("part <> main").withColumn("q", F.pmod(F.xxhash64("cid", F.lit(1)), F.col("qb")).cast("int"))
    asked = asked.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ib") - 1)))
    task = F.xxhash64("family", "i", "q").alias("task")
    return index.select(task, F.lit(0).alias("side"), "cid", "part").union(asked.select(task, F.lit(1).alias("side"), "cid", "part"))


def _class_texts(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(cid, text): a text of each wanted class, from the row of its smallest doc_id."""
    near = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["doc_id"])).select("cid", "text")

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a doc_id can stand for several texts; only the class's own is kept
        for batch in batches:
            cid, text = batch.column(0).to_pylist(), list(_texts([batch], 1))
            yield batch.filter(pa.array([class_of(shingles(t, words)) == c for c, t in zip(cid, text)], pa.bool_()))

    repeated = rows.groupBy("doc_id").count().filter("count > 1").limit(1).count() > 0
    return near.mapInArrow(own, "cid long, text string").dropDuplicates(["cid"]) if repeated else near


def _with_more(links: DataFrame, component: DataFrame, nothing: bool, find: Callable[[], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """All links and their components, after another round of search unless there is nothing to search."""
    found = None if nothing else written(find(), "links")
    if found is None or found.isEmpty():
        return links, component
    links = written(links.union(found), "links")
    return links, connected_components(links)


def _least_ids(group: DataFrame) -> DataFrame:
    """(cid, component_id): the smallest ``rep`` of each class's component. A large component's
    classes are not brought into one task for it."""
    least = group.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("members"))
    return spread_join(group, written(least, "least-ids"), "component", "members", group.count()).select("cid", "component_id")


def similar_groups(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, long_list: int = LONG_LIST, short_hits: int = SHORT_HITS, most_long: int = MOST_LONG
) -> DataFrame:
    """doc_id, n_shingles, component_id of each row: the smallest doc_id reachable by links.

    Null texts and texts without words have no shingles and link with nothing. A null
    doc_id keeps its row; it counts as the largest id. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    named = written(classes(rows, words), "classes")
    by_class = named.filter("cid IS NOT NULL").groupBy("cid").agg(F.min("doc_id").alias("rep"))
    long = long_shingles(rows, long_list, most_long, words)
    found = written(postings(rows, long, percent, short_hits, words), "postings")

    hits_due = F.least(F.lit(short_hits), F.ceil(F.lit(percent) * F.least("n_a", "n_b") / 100))
    short = found.filter("kind = 0").groupBy("a", "b", "n_a", "n_b").agg(F.sum("hits").alias("hits")).filter(F.col("hits") >= hits_due)
    short = written(short.select("a", "b"), "short-pairs")
    places = written(found.filter("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("cid"), F.col("n_b").alias("own")).distinct(), "long-places")
    # the first member of a long list is the one with the fewest shingles of its own: nearest to what all share
    hub = places.groupBy("token").agg(F.min_by("cid", F.struct("own", "cid")).alias("hub"), F.min("own").alias("hub_own"), F.count(F.lit(1)).alias("places"))
    star = written(spread_join(places, written(hub, "hubs"), "token", "places", places.count()).filter("cid <> hub").select(F.col("hub").alias("a"), F.col("cid").alias("b"), "hub_own").distinct(), "stars")
    pairs = written(short.union(star.select("a", "b")).distinct(), "pairs")

    # one row of text for each class that is compared
    wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct().join(by_class, "cid").select("cid", F.col("rep").alias("doc_id"))
    texts = written(_class_texts(rows, wanted, words), "texts")

    # round 1: each class against one partner on short lists and the best first member on long ones
    first = short.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    first = written(first.union(star.groupBy("b").agg(F.min_by("a", F.struct("hub_own", "a")).alias("a")).select("a", "b")).distinct(), "first")
    links = written(search(_pair_tasks(first), texts, percent, words), "links")
    component = connected_components(links)
    # round 2: all other pairs that are still in different groups
    a_of = component.select(F.col("node").alias("a"), F.col("component").alias("of_a"))
    b_of = component.select(F.col("node").alias("b"), F.col("component").alias("of_b"))
    rest = pairs.join(first, ["a", "b"], "left_anti").join(a_of, "a", "left").join(b_of, "b", "left")
    rest = written(rest.filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b"), "rest")
    links, component = _with_more(links, component, rest.isEmpty(), lambda: search(_pair_tasks(rest), texts, percent, words))
    # round 3: members of long lists that are still in different groups
    lists = places.select("token", "cid")
    links, component = _with_more(links, component, lists.isEmpty(), lambda: search(_list_tasks(lists, component), texts, percent, words))

    group = by_class.join(component.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    of_class = _least_ids(written(group, "groups"))
    return named.join(of_class, "cid", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each_group(docs: DataFrame, **how: int) -> DataFrame:
    """The documents, with all their columns, without those that have a linked document of a
    smaller id.

    Rows of the same id are judged together, and of those that also agree in text one
    stays. Rows without an id go where their group has one with an id, else they stay.
    """
    groups = similar_groups(docs, **how)
    gone = written(groups.filter("component_id IS NOT NULL AND NOT (doc_id <=> component_id)").select("doc_id").distinct(), "near-copies")
    kept = docs.join(gone, docs["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti")
    repeated = docs.groupBy("doc_id").count().filter("count > 1").limit(1).count() > 0
    return kept.dropDuplicates(["doc_id", "text"]) if repeated else kept
