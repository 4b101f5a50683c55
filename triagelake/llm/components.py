"""Connected components of an edge table by repeated contraction, entirely in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.session import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): equal labels for connected nodes; nodes without an edge do not appear.

    Each round joins every node to the smallest of its neighbours and itself and contracts the edges; hash-like node
    names make that a number of rounds logarithmic in the size.  Loops, repeated edges and an empty table are allowed.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    edges = cut_lineage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    known = None
    while edges.head(1):
        both = edges.union(edges.select("b", "a"))
        parent = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("to")), "parents")
        pa, pb = parent.toDF("a", "ta"), parent.toDF("b", "tb")
        if known is None:
            known = parent.withColumnRenamed("to", "label")
        else:
            moved = known.join(parent.toDF("label", "to"), "label", "left")
            known = cut_lineage(moved.select("node", F.coalesce("to", "label").alias("label")), "labels")
        edges = edges.join(pa, "a").join(pb, "b").where("ta <> tb")
        edges = cut_lineage(edges.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
    if known is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return known
