"""Connected components of an edge table by alternating large-star and small-star steps.

Each step regroups edges around the smallest neighbour, so labels spread in O(log n) rounds;
edges never leave the executors.  Each round is written to the shared checkpoint folder, which
cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.sources.store import materialize

EDGES_PER_TASK = 250_000


def _with_min(edges: DataFrame) -> DataFrame:
    """(u, v, m): every edge with the smallest of u and its neighbours.  The minimum is combined
    before the shuffle, and a hub's rows are split by the skew join, so no task holds a hub whole."""
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    return edges.join(low, F.col("u") == F.col("_u")).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_min(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    j = _with_min(down.distinct().coalesce(tasks)).coalesce(tasks)
    return (
        j.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(j.select("u", F.col("m").alias("v")))
        .filter("u <> v")
        .distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component is the smallest node reached.

    Loops, repeated edges and either direction are accepted; nulls are ignored; without edges
    the result is empty.
    """
    cur = materialize(
        edges.filter("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "cc-edges",
    )
    seen = None
    while True:
        mark = tuple(cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen or not mark[0]:
            break
        seen = mark
        tasks = -(-mark[0] // EDGES_PER_TASK)
        cur = materialize(_small_star(_large_star(cur).coalesce(tasks), tasks).coalesce(tasks), "cc-edges")
    # converged: every edge is (node, smallest node), the smallest itself has no row
    out = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return out.union(out.select("component", "component").distinct())
