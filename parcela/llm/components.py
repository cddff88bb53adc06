"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcela.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node of its component.

    Each round sends a node to the smallest of its neighbours and itself and contracts the edges; a
    star takes one round, a path of n nodes about log n.  Minima are combined before the shuffle and
    all joins read stored tables, so that a node with a third of all edges can be split.
    """
    edges = stored(edges.where("a <> b").distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        parent = stored(parent, "parents")
        if roots is None:
            roots = parent.select(F.col("n").alias("node"), F.col("m").alias("root"))
        else:
            moved = roots.join(parent, F.col("root") == F.col("n"), "left")
            roots = stored(moved.select("node", F.coalesce("m", "root").alias("root")), "roots")
        left = edges.join(parent, F.col("a") == F.col("n")).select(F.col("m").alias("a"), "b")
        next_edges = left.join(parent, F.col("b") == F.col("n")).select("a", F.col("m").alias("b"))
        edges = stored(next_edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                       "edges")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
