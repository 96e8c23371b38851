"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.scratch import RoundTable, Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's greater neighbours go to its smallest neighbour, or to itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("low", "a"))
    return both.join(least, "a").where("b > a").select(F.col("low").alias("a"), "b").where("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours go to the smallest of these; here ``a < b``."""
    least = edges.groupBy("b").agg(F.min("a").alias("low"))
    joined = edges.join(least, "b")
    return (
        joined.where("a != low").select(F.col("low").alias("a"), F.col("a").alias("b"))
        .unionByName(least.select(F.col("low").alias("a"), "b"))
    )


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """``(class, component)``: the smallest number of its component for every linked number.

    ``links`` are pairs ``(a, b)``. Rounds go on until the edges are stars around the smallest
    number; each is a written table of at most as many edges as the one before.
    """
    edges = scratch.write(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(),
        **_print(),
    )
    while edges.rows:
        turned = scratch.write(_small_star(_large_star(edges.df).distinct()).distinct(), **_print())
        same = _same(edges, turned)
        edges = turned
        if same:
            break
    stars = edges.df
    return stars.select(F.col("b").alias("class"), F.col("a").alias("component")).unionByName(
        stars.select(F.col("a").alias("class"), F.col("a").alias("component")).distinct()
    )


def _print() -> dict:
    return {
        "sum": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        "xor": F.bit_xor(F.xxhash64("b", "a")),
    }


def _same(left: RoundTable, right: RoundTable) -> bool:
    return left.rows == right.rows and left.counts == right.counts
