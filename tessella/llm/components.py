"""Connected components by randomised contraction, in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b`` (long); a root stands for one component.

    Each round every node joins the node of its closed neighbourhood that comes first in an order
    drawn anew for the round; edges between the chosen nodes go on. The graph shrinks by a
    constant factor a round in expectation, whatever its shape, and every step is a partial
    aggregate or an equi-join with a table of one row a node. Loops and repeated edges may occur;
    no edges give no rows.
    """
    e = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels, k = None, 0
    while labels is None or not e.isEmpty():
        k += 1
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", F.lit(k)).alias("h"), F.col("b").alias("to"))).alias("m"))
        own = F.xxhash64("a", F.lit(k))
        chosen = staged(first.select(F.col("a").alias("node"), F.when(own <= F.col("m.h"), F.col("a")).otherwise(F.col("m.to")).alias("to")), "chosen")
        left = chosen.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = chosen.select(F.col("node").alias("b"), F.col("to").alias("y"))
        fewer = e.join(left, "a").join(right, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        fewer = staged(fewer, "edges")
        if labels is None:
            labels = staged(chosen.withColumnRenamed("to", "root"), "labels")
            discard(chosen)
            discard(e)
        else:
            nxt = chosen.select(F.col("node").alias("root"), F.col("to").alias("nxt"))
            further = staged(labels.join(nxt, "root", "left").select("node", F.coalesce("nxt", "root").alias("root")), "labels")
            discard(labels, chosen, e)
            labels = further
        e = fewer
    discard(e)
    return labels
