"""Connected components by alternating star contraction, on DataFrames alone.

Each round hangs every node's larger neighbours on its smallest one (and its smaller
ones on the smallest), until all edges point at roots. Rounds are written to the shared
folder, which cuts their lineage; a round aggregates minima and joins them back, so a
node with very many edges is no group in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize


def _hang(pairs: DataFrame) -> DataFrame:
    """Every neighbour of a node, and the node, pointed at the smallest of them."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    least = least.withColumn("least", F.least("node", "least"))
    moved = pairs.join(least, "node").select(F.col("other").alias("node"), F.col("least").alias("other"))
    own = least.select("node", F.col("least").alias("other"))
    return moved.unionByName(own).filter("node > other").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: longs) that isn't its own root; a
    root is the smallest node of its component."""
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    current = materialize(down.distinct(), "edges")
    while True:
        # Of the larger neighbours: each node sees those above it (and itself).
        both = current.unionByName(current.select(F.col("other").alias("node"), F.col("node").alias("other")))
        least = both.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("node", "least"))
        up = both.filter("other > node").join(least, "node")
        large = up.select(F.col("other").alias("node"), F.col("least").alias("other")).distinct()
        current = materialize(_hang(large), "stars")
        several = current.groupBy("node").count().filter("count > 1")
        chained = current.join(current.select(F.col("node").alias("other")), "other", "left_semi")
        if several.isEmpty() and chained.isEmpty():
            return current.select("node", F.col("other").alias("root"))
