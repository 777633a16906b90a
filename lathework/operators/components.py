"""Connected components of an undirected graph given as edges, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.session import cut_lineage


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
    return int(row[0]), int(row[1] or 0)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v")


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its least node.

    Alternating large-star and small-star steps: every step is an aggregation with map-side combine
    and a join on the same key, edges never outgrow the input, and the number of rounds is about the
    logarithm of the longest chain. Every round is checkpointed to the shared folder, so a lost
    executor costs one round at most. Null ends, loops and repeated edges are ignored; an empty
    table gives none. Raises RuntimeError if ``most_rounds`` don't suffice.
    """
    now = edges.select(F.greatest(edges[a], edges[b]).alias("u"), F.least(edges[a], edges[b]).alias("v"))
    now = cut_lineage(now.where("u <> v").distinct())
    before = _state(now)
    if before[0] == 0:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(most_rounds):
        now = cut_lineage(_small_star(_large_star(now)).distinct())
        after = _state(now)
        if after == before:
            leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return leaves.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = after
    raise RuntimeError("components: no fixed point")
