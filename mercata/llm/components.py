"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.session import cut_lineage


def large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the least of its neighbours and itself."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    tied = edges.join(least, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return tied.union(least.select(F.col("m").alias("a"), "b")).distinct()


def star_forest(edges: DataFrame) -> DataFrame:
    """Rows (a, b): the smallest node of a component and each other node of it.

    ``edges`` has rows a < b, repeats allowed. Minima are counted with map-side combine and joined
    back, so a node with very many neighbours is never gathered in one task. Each round's edges are
    written to the shared folder; the rounds, about the square of the logarithm of the longest
    chain, end when one changes nothing.
    """
    edges = cut_lineage(edges.distinct(), "edges")
    before = None
    while True:
        summary = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if summary == before or not summary[0]:
            return edges
        before = summary
        edges = cut_lineage(small_star(large_star(edges)), "edges")
