"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a map-side combined minimum per vertex and one join; a vertex with very many
edges is an ordinary hot join key (split at run time), never one task's list. The edges of
each round are written to the shared folder, so a lost executor re-reads files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges(u, v): u > v. Link every larger (large) or smaller neighbour of a vertex to its least neighbour."""
    both = edges.select("u", "v")
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("u", "m").alias("m"))
    linked = both.join(least, F.col("u") == F.col("at"))
    if large:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("at").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of long vertices -> (vertex, root): the least vertex reachable, for every vertex that is not itself the least.

    No edges: an empty table. Self-links and repeated links are ignored.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = materialize(now, "components")
    mark = None
    for _ in range(max_rounds):
        now = materialize(_star(_star(now, True), False), "components")
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (seen.n, seen.s) == mark:
            break
        mark = (seen.n, seen.s)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
