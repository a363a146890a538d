"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelon.storage import discard, store


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(xxhash64(v, u) as decimal(38,0)))")).first())


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) for each node of ``edges`` (u, v), root the smallest node that can be reached.

    Every round uses minimum aggregates (combined before the shuffle) and equi-joins that adaptive
    execution can split, so a node with very many links isn't gathered in a task. Each round's links are stored in the
    shared folder, and those before them deleted. Self links are dropped; an empty table gives an empty result.
    """
    edges = store(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _mark(edges)
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = store(large.distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        old, edges = edges, store(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        discard(old)
        discard(large)
        if (now := _mark(edges)) == before:
            break
        before = now
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
