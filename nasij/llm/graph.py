"""Connected components as alternating star contractions on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nasij.llm.common import Written

HUBS, FEW = 1000, 10_000


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has an edge to another node.

    ``component`` is the smallest node reachable. Large-star and small-star
    rounds (each two aggregations with map-side partial minima and two joins)
    repeat until the edges no longer change: O(log n) rounds in practice. A node
    with more than one ``HUBS``-th of all edges, and ``FEW`` at least, is a hub:
    there are at most twice ``HUBS``, so their minima are broadcast and their
    edges stay where they are; the edges of any other node are few enough for a
    task. Every round is written to the shared folder; nothing is collected but
    three numbers. Null ends and self-loops are ignored; repeated edges count
    once.
    """
    now = Written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
        .distinct(),
        "cc",
    )
    seen = None
    for _ in range(max_rounds):
        state = _state(now.df)
        if state == seen or not state[0]:
            break
        seen = state
        after = Written(_small_star(_large_star(now.df, state), state), "cc")
        now.drop()
        now = after
    else:
        raise RuntimeError("components did not settle")
    return now.df.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _state(e: DataFrame) -> tuple:
    """Edges, a sum of their hashes, and the largest degree."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    both = e.select("u", h.alias("h")).unionByName(e.select(F.col("v").alias("u"), F.lit(0).cast("decimal(38,0)").alias("h")))
    r = both.groupBy("u").agg(F.count(F.lit(1)).alias("c"), F.sum("h").alias("h")).agg(F.sum("c"), F.sum("h"), F.max("c")).first()
    return (r[0] or 0) // 2, r[1], r[2] or 0


def _with_least(e: DataFrame, least: DataFrame, state: tuple) -> DataFrame:
    """Each edge with its node's minimum; ``c`` of ``least`` is the degree."""
    hub = max(FEW, state[0] // HUBS)
    if state[2] <= hub:
        return e.join(least.select("u", "m"), "u")
    # at most 2 * HUBS rows, as the degrees sum up to at most twice the edges
    hubs = least.where(F.col("c") > hub).select("u", "m", F.lit(True).alias("hub"))
    marked = e.join(F.broadcast(hubs), "u", "left")
    rest = marked.where("hub is null").select("u", "v").join(least.select("u", "m"), "u")
    return marked.where("hub").select("u", "v", "m").unionByName(rest)


def _large_star(e: DataFrame, state: tuple) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("c"))
    return _with_least(both, least, state).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame, state: tuple) -> DataFrame:
    e = e.distinct()
    least = e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("c"))
    moved = _with_least(e, least, state).where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") > F.col("v")).distinct()
