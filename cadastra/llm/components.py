"""Connected components of a large graph by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.session import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the least of them and it: the larger neighbours, or the smaller ones."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = both.join(least, "a")
    moved = hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``: the least node reachable. Loops and repeated links do no harm.

    Each round is written to the shared folder, so a lost executor costs a round at most; rounds grow with the logarithm
    of the longest chain. Equal counts and checksums of two rounds end the loop. No links: no rows.
    """
    current, before = written(edges.select("a", "b").where("a <> b").distinct()), None
    while True:
        current = written(_stars(_stars(current, True), False))
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    return current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).union(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
