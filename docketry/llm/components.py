"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _with_least(rows: DataFrame, low: DataFrame, edges: int, hub: int) -> DataFrame:
    """rows (a, b) with m of low (a, m, n). Nodes with many neighbours, which would be large tasks, get theirs by broadcast: of e edges at most
    2 * e / hub nodes have hub neighbours, and hub grows with e, so they are two million at most; the others meet by a join."""
    hub = max(hub, edges // 1_000_000)
    hubs = F.broadcast(low.where(F.col("n") >= hub).select("a", "m"))
    few = rows.join(hubs.select("a"), "a", "left_anti").join(low.where(F.col("n") < hub).select("a", "m"), "a")
    return few.select("a", "b", "m").unionByName(rows.join(hubs, "a").select("a", "b", "m"))


def components(edges: DataFrame, most_rounds: int = 60, hub: int = 500) -> DataFrame:
    """(id, component) for the ends of edges (a, b); component is the smallest id that is reached.

    Large-star and small-star turns: each links all larger neighbours of a node, then all smaller ones, to the smallest, so paths
    shrink by half and more. Each turn is a few aggregations and joins over the edges; nothing but a count comes to the driver. No edges give no rows.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = stored(e, "edges")
    before, size = None, e.count()
    for _ in range(most_rounds):
        # large star: every larger neighbour goes to the smallest of the node and its neighbours
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n"), "least")
        large = _with_least(both, low, size, hub).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: every smaller neighbour, and the node, go to the smallest
        large = stored(large.where("a <> b").distinct(), "large")
        low = stored(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "least")
        small = _with_least(large, low, size, hub).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        e = stored(small, "edges")
        now = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        size = now[0]
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    ids = e.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return ids.unionByName(ids.select(F.col("component").alias("id"), "component").distinct())
