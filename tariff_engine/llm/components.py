"""Connected components of a graph in DataFrames, by alternating large and small stars.

Each round replaces edges by edges to smaller neighbours, written to the shared folder; the components are found
when a round changes nothing. No node's neighbours are ever gathered: minima are combined before the shuffle, and a
hub's edges are rows of a join that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariff_engine.llm import scratch


def _star(edges: DataFrame) -> DataFrame:
    """Every edge (u, v) of both directions with the least of u's neighbours and u itself as ``m``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b): the component's least node.

    Self-loops and repeated edges do no harm; an empty table gives none.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = scratch.written(now, "edges")
    seen = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = _star(large)  # u is the larger end of every edge here
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        now = scratch.written(small.where("u <> v").distinct(), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
