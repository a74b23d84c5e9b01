"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.plans.storage import scratch_dir, written


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of ``edges`` (a, b; longs) reaches. Null ends and loops are ignored.

    Large-star and small-star steps in turn (Kiveris et al., 2014): first every larger neighbour of a node is linked to
    its smallest neighbour, then every smaller one and the node itself. Each step is one grouping for the smallest
    neighbour and one join, so that a node with very many neighbours is never gathered; its join partitions can be split.
    Steps are written below ``spark.checkpoint.dir``; the loop ends when a round changes nothing, after a number of
    rounds that grows with the logarithm of the longest path.
    """
    base = scratch_dir(edges.sparkSession)

    def star(df: DataFrame, large: bool) -> DataFrame:
        # n: the node, x: a neighbour; large looks at all neighbours, small at those below the node
        both = df.select(F.col("a").alias("n"), F.col("b").alias("x"))
        if large:
            both = both.union(df.select(F.col("b").alias("n"), F.col("a").alias("x")))
        else:
            both = both.select(F.greatest("n", "x").alias("n"), F.least("n", "x").alias("x"))
        smallest = both.groupBy("n").agg(F.min(F.least("n", "x")).alias("m"))
        joined = both.join(smallest, "n")
        if large:
            out = joined.where("x > n").select(F.col("x").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("x").alias("a"), F.col("m").alias("b")).union(smallest.select(F.col("n").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    current = written(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b").distinct(), f"{base}/0")
    before, round_ = None, 0
    while True:
        round_ += 1
        current = written(star(star(current, True), False), f"{base}/{round_}")
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).groupBy("node").agg(F.min("root").alias("root"))
