"""Connected components of an edge table, by contraction in Spark.

Each round every node points to its smallest neighbour (a partial aggregation,
so a node of any degree folds on the map side), pointers are followed to their
roots by doubling, and the edges are rewritten to roots, made distinct and
freed of loops. Every node that still has an edge merges at least once a round,
so the number of rounds is logarithmic. Rounds are written to shared storage;
the driver only sees whether an edge is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node it reaches.

    Edges are undirected; loops, repeated edges and edges with a NULL end are
    allowed (the last are ignored).
    """
    left = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    left = stored(left.distinct(), "edges")
    found: DataFrame | None = None
    while True:
        ends = left.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(left.select(F.col("b").alias("node"), F.col("a").alias("to")))
        up = stored(ends.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("root")), "parents")
        while True:
            two = up.alias("x").join(up.select(F.col("node").alias("root"), F.col("root").alias("above")), "root", "left")
            moved = stored(two.select("node", F.coalesce("above", "root").alias("root"), (F.col("above") != F.col("root")).alias("moved")), "parents")
            up = moved.select("node", "root")
            if moved.where("moved").isEmpty():
                break
        if found is None:
            found = up
        else:
            step = found.join(up.select(F.col("node").alias("root"), F.col("root").alias("above")), "root", "left")
            found = stored(step.select("node", F.coalesce("above", "root").alias("root")), "roots")
        at = left.join(up.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").select("ra", "b")
        at = at.join(up.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").where("ra <> rb")
        left = stored(at.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        if left.isEmpty():
            return found


def joined(reached: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) when ``edges`` (a, b) are added to the graph that ``reached`` (node, root) is of: an edge per node stands for the old ones."""
    return components(reached.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(edges.select("a", "b")))
