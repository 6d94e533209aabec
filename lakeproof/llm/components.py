"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeproof.llm.support import staged


def connected_components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of every node in (a, b) links; the component is its smallest node.

    Each round hangs every node's neighbours on the smallest of them, first the larger ones, then
    the smaller ones, until nothing changes; that takes about as many rounds as the logarithm of the
    longest chain. Smallest neighbours are taken before the shuffle; a node with very many links
    meets them in a join that adaptive execution splits. Only two numbers reach the driver.
    """
    edges = staged(_oriented(links), f"{label}-links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.least(F.min("low"), F.first("high")).alias("least"))
        # every neighbour above a node hangs on the least of the node's neighbourhood
        large = both.join(least, "high").where(F.col("low") > F.col("high")).select(
            F.col("low").alias("a"), F.col("least").alias("b")
        )
        large = _oriented(large)
        nearest = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(nearest, "high").select(F.col("low").alias("a"), F.col("least").alias("b")).unionByName(
            nearest.select(F.col("high").alias("a"), F.col("least").alias("b"))
        )
        edges = staged(_oriented(small), f"{label}-round")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )


def _oriented(links: DataFrame) -> DataFrame:
    return links.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
    return row[0], row[1]
