"""Connected components of a table of links, by randomised contraction.

In each round a node is merged into the node of the smallest keyed hash among itself and
its neighbours, and the links are rewritten between what is left. At least a third of the
nodes go in a round on average, chains in any order of ids included, so the links that are
joined shrink from round to round; no round joins all of them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linksift.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that is reachable, for all nodes of ``links`` (a, b).

    Nodes without links are not in the result, nor are those of null; an empty table gives
    an empty one. Each round's table is written to the shared folder. A node's links are
    combined before the shuffle; the joins on nodes of very many links are split by adaptive
    execution.
    """

    def both_ways(pairs: DataFrame) -> DataFrame:
        pairs = pairs.filter("a <> b")
        return pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()

    edges = written(both_ways(links.select("a", "b")), "edges")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        salt = F.lit(len(rounds))
        near = edges.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(F.xxhash64(salt, "b").alias("h"), F.col("b").alias("to"))).alias("best"))
        own = F.struct(F.xxhash64(salt, "node").alias("h"), F.col("node").alias("to"))
        into = written(near.select("node", F.least("best", own)["to"].alias("to")), "merged")
        # the node that one is merged into is merged itself: follow it once
        into = written(into.join(into.select(F.col("node").alias("to"), F.col("to").alias("then")), "to").select("node", F.col("then").alias("to")), "merged")
        rounds.append(into)
        half = edges.join(into.withColumnRenamed("node", "a"), "a").select(F.col("to").alias("a"), "b")
        whole = half.join(into.withColumnRenamed("node", "b"), "b").select("a", F.col("to").alias("b"))
        edges = written(both_ways(whole), "edges")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    found = rounds[0]
    for later in rounds[1:]:
        found = found.join(later.select(F.col("node").alias("to"), F.col("to").alias("then")), "to", "left").select("node", F.coalesce("then", "to").alias("to"))
    found = written(found, "merged")
    least = found.groupBy("to").agg(F.min("node").alias("component"))
    return written(found.join(least, "to").select("node", "component"), "components")
