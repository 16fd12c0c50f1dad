"""Connected components of an edge table, by alternating large and small stars.

Each round points every node's larger neighbours, then its smaller ones, at
its smallest neighbour; the number of rounds grows with the logarithm of the
number of nodes.  Neighbours are never gathered: a round is a grouped minimum,
combined before the shuffle, and a join that adaptive execution splits at
nodes of very many edges.  Each round's edges go to the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake.session import materialize


def star(edges: DataFrame) -> DataFrame:
    """Every edge (u, v) moved to (v, smallest of u's neighbours and u)."""
    least = edges.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
    return edges.join(least.withColumn("m", F.least("m", "x")), F.col("u") == F.col("x"))


def components(edges: DataFrame) -> DataFrame:
    """Nodes of (u, v) with the smallest node that they reach: (node, root).

    Edges need no order and may repeat; nodes without an edge to another do not
    occur in the result.
    """
    e = edges.select("u", "v").filter(F.col("u") != F.col("v"))
    e = materialize(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        # Large star: a node's larger neighbours go to its smallest one.
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: a node and its smaller neighbours go to the smallest one.
        down = large.filter("u != v").distinct()
        small = star(down)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            small.select("u", F.col("m").alias("v"))
        )
        e = materialize(small.filter("u != v").distinct())
        after = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
