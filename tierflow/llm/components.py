"""Connected components by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierflow.llm.common import attach, stored


def _pointed(edges: DataFrame, total: int) -> DataFrame:
    """(u, v, m): each neighbour v of u beside the smallest of u and its neighbours.

    A node with very many neighbours is met by broadcasting its one row.
    """
    least = stored(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("size")), "least")
    return attach(edges, least, "u", "size", total)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) of longs; the root is a component's smallest node.

    Large-star links each node's larger neighbours to its smallest one, small-star its
    smaller ones and itself; their alternation ends in stars after a number of rounds that
    grows with the logarithm of the size. Each round is stored in the shared folder.
    """
    current = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")

    def state(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pointed(both, 2 * before[0]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct(), "large")
        # Every edge goes from the larger to the smaller node here.
        near = _pointed(large, large.count())
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            near.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        current = stored(small, "small")
        after = state(current)
        if after == before:
            break
        before = after
    roots = current.select("v").distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
