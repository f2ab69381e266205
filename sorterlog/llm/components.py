"""Connected components of a graph given as a table of edges.

Each round replaces edges by edges to the smallest neighbour (first for all
larger neighbours, then for all smaller ones), which turns every component
into a star around its smallest node in a few rounds. Only edges are
shuffled; minima are combined before the shuffle, so a node with very many
edges is no burden. Every round is written, which cuts the lineage, and the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorterlog.sources.staging import stage, unstage


def _towards_minimum(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v): each v and u itself get an edge to the least of u and its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """Edges (a, b) of long ids to (node, root): the smallest node reachable, for every node of an edge between two different nodes."""
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        pulled = _towards_minimum(large)
        small = pulled.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        before = now
        now = stage(small.select("e.*").where("u <> v").distinct(), "edges")
        last, state = state, now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        ).first()
        unstage(before)
        if state == last:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct(),
            )
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")
