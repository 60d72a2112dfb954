"""Approximate nearest neighbours by a hierarchical navigable small-world graph per shard.

Vectors are dealt into shards of about the same size. Each shard is one row of the
index table: its vectors, its graph as one flat array of neighbours per level, and the
entry point. A graph is built by inserting vectors in batches that double in size:
every vector of a batch searches the graph so far, from the top level down, chooses
diverse neighbours among what it found, and is linked both ways. A query searches
every shard; the shards' nearest are scored again in double precision and merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linksift.llm.common import written

SHARD_ROWS = 2048
LINKS = 16  # per node and level; twice as many on the lowest
EF_BUILD = 64
EF_SEARCH = 96
QUERY_BLOCK = 512
INDEX_SCHEMA = "dim int, shard int, n int, ids binary, vectors binary, member binary, levels array<binary>, level_nodes array<binary>, entry int"


def _splitmix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def level_of(keys: np.ndarray, links: int = LINKS) -> np.ndarray:
    """Level of each node: geometric, from a hash of its key."""
    u = (_splitmix(keys.astype(np.uint64)) >> np.uint64(11)).astype(float) / float(1 << 53)
    return np.floor(-np.log(np.maximum(u, 1e-18)) / np.log(links)).astype(int)


def search_level(x: np.ndarray, norms: np.ndarray, graph: np.ndarray, q: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of many queries at once on one level: the ``ef`` nearest nodes found
    (-1 where fewer) and their squared distances, ascending. ``entry``: start nodes,
    queries x m, -1 for none."""
    m, n = len(q), len(x)
    rows = np.arange(m)[:, None]
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = True

    def distance(nodes: np.ndarray) -> np.ndarray:
        flat = np.where(nodes < 0, 0, nodes)
        d = norms[flat] - 2 * np.einsum("mkd,md->mk", x[flat], q)
        return np.where(nodes < 0, np.inf, d)

    def beam(ids: np.ndarray, d: np.ndarray, done: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(d, axis=1, kind="stable")[:, :ef]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1), np.take_along_axis(done, order, 1)

    seen[rows, np.where(entry < 0, n, entry)] = True
    ids, d, done = beam(entry, distance(entry), entry < 0)
    live = np.arange(m)
    while len(live):
        wait = np.where(done[live], np.inf, d[live])
        at = wait.argmin(1)
        open_ = np.isfinite(wait[np.arange(len(live)), at])
        live, at = live[open_], at[open_]
        if not len(live):
            break
        done[live, at] = True
        near = graph[ids[live, at]]
        near = np.where(seen[live[:, None], near], -1, near)
        # a node that two links of this step lead to is taken once
        srt = np.sort(near, axis=1)
        srt[:, 1:][srt[:, 1:] == srt[:, :-1]] = -1
        seen[live[:, None], np.where(srt < 0, n, srt)] = True
        flat = np.where(srt < 0, 0, srt)
        nd = np.where(srt < 0, np.inf, norms[flat] - 2 * np.einsum("mkd,md->mk", x[flat], q[live]))
        all_ids, all_d = np.concatenate((ids[live], srt), 1), np.concatenate((d[live], nd), 1)
        all_done = np.concatenate((done[live], srt < 0), 1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :ef]
        if ids.shape[1] < order.shape[1]:
            pad = order.shape[1] - ids.shape[1]
            ids = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1)
            d = np.pad(d, ((0, 0), (0, pad)), constant_values=np.inf)
            done = np.pad(done, ((0, 0), (0, pad)), constant_values=True)
        ids[live] = np.take_along_axis(all_ids, order, 1)
        d[live] = np.take_along_axis(all_d, order, 1)
        done[live] = np.take_along_axis(all_done, order, 1) | ~np.isfinite(d[live])
    return np.where(np.isfinite(d), ids, -1), d


def choose(x: np.ndarray, of: int, ids: np.ndarray, d: np.ndarray, links: int) -> list[int]:
    """Diverse neighbours: a candidate nearer to one chosen already than to the node waits;
    what room is left goes to the nearest that waited."""
    kept: list[int] = []
    waiting: list[int] = []
    between = x[ids] @ x[ids].T
    sq = np.einsum("ij,ij->i", x[ids], x[ids])
    apart = sq[:, None] + sq[None, :] - 2 * between
    own = d + np.dot(x[of], x[of])
    at: list[int] = []
    for k in range(len(ids)):
        if len(kept) == links:
            break
        if at and (apart[k, at] < own[k]).any():
            waiting.append(int(ids[k]))
        else:
            kept.append(int(ids[k]))
            at.append(k)
    return kept + waiting[: links - len(kept)]


def build(x: np.ndarray, keys: np.ndarray, links: int = LINKS, ef: int = EF_BUILD) -> tuple[list[np.ndarray], int]:
    """Flat neighbour arrays (nodes x width, -1 for none), lowest level first, and the entry."""
    n = len(x)
    norms = np.einsum("ij,ij->i", x, x)
    level = level_of(keys, links)
    top = int(level.max())
    graphs = [np.full((n, 2 * links if k == 0 else links), -1, np.int32) for k in range(top + 1)]
    order = np.lexsort((keys, -level))  # upper nodes first: they are the ways into the graph
    entry = int(order[0])
    at, step = 1, 1
    while at < n:
        batch = order[at : at + step]
        start = np.full((len(batch), 1), entry)
        for k in range(top, -1, -1):
            found, d = search_level(x, norms, graphs[k], x[batch], start, ef if k else ef)
            start = found[:, : max(1, ef // 4)]
            here = np.flatnonzero(level[batch] >= k)
            width = graphs[k].shape[1]
            back: dict[int, list[int]] = {}
            for b in here.tolist():
                ok = found[b] >= 0
                node = int(batch[b])
                ok &= found[b] != node
                chosen = choose(x, node, found[b][ok], d[b][ok], links)
                graphs[k][node, : len(chosen)] = chosen
                for c in chosen:
                    back.setdefault(c, []).append(node)
            for c, nodes in back.items():
                have = graphs[k][c][graphs[k][c] >= 0]
                both = np.unique(np.concatenate((have, nodes)))
                both = both[both != c]
                if len(both) > width:
                    dist = norms[both] - 2 * x[both] @ x[c]
                    near = np.argsort(dist, kind="stable")
                    both = np.array(choose(x, c, both[near], dist[near], width))
                graphs[k][c] = -1
                graphs[k][c, : len(both)] = both
        at += len(batch)
        step = min(2 * step, 256)
    return graphs, entry


def descend(x: np.ndarray, graphs: list[np.ndarray], entry: int, q: np.ndarray, ef: int) -> np.ndarray:
    """Nodes nearest to each query, nearest first, -1 where fewer were found."""
    norms = np.einsum("ij,ij->i", x, x)
    start = np.full((len(q), 1), entry)
    for k in range(len(graphs) - 1, -1, -1):
        start, _ = search_level(x, norms, graphs[k], q, start, ef if k == 0 else 8)
    return start


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v (double), dim: vectors that take part; null ids, and vectors that are null,
    empty or zero or hold a null, NaN or infinite component, don't."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("v"))
    return rows.filter("vec_id IS NOT NULL AND v IS NOT NULL").filter(~bad & F.exists("v", lambda c: c != 0)).withColumn("dim", F.size("v"))


def build_index(rows: DataFrame, shard_rows: int = SHARD_ROWS, links: int = LINKS, ef: int = EF_BUILD) -> DataFrame:
    """One row per shard. ``rows`` as ``usable`` returns them; equal vectors of a shard are one
    node with several members. Shards are ranges of a hash of the id, per dimension."""
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        ids, full = pdf["vec_id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()).astype(np.float64)
        nodes, first, member = np.unique(full, axis=0, return_index=True, return_inverse=True)
        x = full[first]
        shift = x.mean(0)  # squares of far-off vectors would lose digits
        graphs, entry = build(x - shift, ids[first].astype(np.uint64), links, ef)
        held = [np.flatnonzero((g >= 0).any(1)).astype(np.int32) if k else np.arange(len(x), dtype=np.int32) for k, g in enumerate(graphs)]
        return pd.DataFrame([{
            "dim": key[0], "shard": key[1], "n": len(x), "ids": ids.tobytes(), "vectors": x.tobytes(), "member": member.astype(np.int32).reshape(-1).tobytes(),
            "levels": [g[h].tobytes() for g, h in zip(graphs, held)], "level_nodes": [h.tobytes() for h in held], "entry": entry,
        }])

    return written(dealt.groupBy("dim", "shard").applyInPandas(one, INDEX_SCHEMA), "hnsw-index")


def search_index(index: DataFrame, queries: DataFrame, k: int = 10, ef: int = EF_SEARCH, links: int = LINKS) -> DataFrame:
    """query_id, vec_id, score: from every shard the ``k`` nearest found to each query, other
    than itself. Queries go in blocks; each block meets each shard of its dimension
    once."""
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    packed = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).groupBy("dim", "block").agg(
        F.collect_list(F.struct("vec_id", "v")).alias("asked")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:  # Spark bounds a batch by bytes as well as by rows
            for r in pdf.itertuples(index=False):
                x = np.frombuffer(r.vectors, np.float64).reshape(r.n, r.dim)
                shift = x.mean(0)
                ids, member = np.frombuffer(r.ids, np.int64), np.frombuffer(r.member, np.int32)
                by_node = np.argsort(member, kind="stable")  # members of a node in id order
                begin = np.searchsorted(member[by_node], np.arange(r.n + 1))
                graphs = []
                for level, (flat, nodes) in enumerate(zip(r.levels, r.level_nodes)):
                    width = links if level else 2 * links
                    g = np.full((r.n, width), -1, np.int32)
                    g[np.frombuffer(nodes, np.int32)] = np.frombuffer(flat, np.int32).reshape(-1, width)
                    graphs.append(g)
                q_ids = np.array([a["vec_id"] for a in r.asked], np.int64)
                q = np.array([a["v"] for a in r.asked], np.float64)
                found = descend(x - shift, graphs, r.entry, q - shift, max(ef, k + 1))
                for i, nodes in enumerate(found):
                    nodes = nodes[nodes >= 0]
                    d = np.sqrt(((x[nodes] - q[i]) ** 2).sum(1))
                    vec, score = [], []
                    for node, dist in sorted(zip(nodes.tolist(), d.tolist()), key=lambda p: p[1])[: k + 1]:
                        own = ids[by_node[begin[node] : begin[node + 1]]][: k + 1]
                        own = own[own != q_ids[i]]
                        vec.append(own)
                        score.append(np.full(len(own), dist))
                    vec, score = np.concatenate(vec), np.concatenate(score)
                    best = np.lexsort((vec, score))[:k]
                    yield pd.DataFrame({"query_id": q_ids[i], "vec_id": vec[best], "score": score[best]})

    shards = index.groupBy("dim").agg(F.max("shard").alias("last"))
    asked = packed.join(shards, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), "last"))).drop("last")
    return index.join(asked, ["dim", "shard"]).mapInPandas(run, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, shard_rows: int = SHARD_ROWS, ef: int = EF_SEARCH) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``every`` the ``k``
    nearest other rows found, by Euclidean distance, ties to the smaller id.

    Vectors of different lengths are not compared. An id that stands twice is two
    candidates for others, none for itself. Other columns are not read.
    """
    rows = written(usable(vectors), "vectors")
    index = build_index(rows, shard_rows)
    found = search_index(index, rows.filter(F.col("vec_id") % every == 0), k, ef)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
