"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import stash


def _towards_minimum(arcs: DataFrame, keep: str) -> DataFrame:
    """Send every arc (u, v) with ``keep`` to the least of u and its neighbours."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m"))
    least = stash(least.select("u", F.least("u", "m").alias("m")), "least")  # splits hot hubs
    return arcs.where(keep).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the least id reachable.

    Each round shortens every path and is written out, so that lineage and plans stay
    short and a lost executor costs one round.  Least neighbours are partial
    aggregates and the joins can be split, so a hub of any size is dealt out.
    """
    edges = stash(links.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_minimum(both, "v > u").where("u != v").distinct()
        arcs = large.where("u > v")
        small = _towards_minimum(arcs, "true").union(
            arcs.groupBy("u").agg(F.min("v").alias("v")))
        edges = stash(small.where("u != v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40)),
                        F.count_distinct("u")).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
