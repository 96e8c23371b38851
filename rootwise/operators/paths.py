"""Distances and the part of a graph below a root."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.model import FormulaGraph, GraphError
from rootwise.operators.ranges import reach_by_ranges
from rootwise.operators.spread import reach, spread_min, spread_rounds
from rootwise.scratch import Scratch

# Rounds after which a search that needs no distances goes on by ranges of ids.
SEARCH_ROUNDS = 4


def hop_distances(graph: FormulaGraph, landmarks: DataFrame) -> DataFrame:
    """``(id, landmark, distance)``: hops along the edges from ``id`` to each landmark.

    ``landmarks(id)`` are the targets; a landmark is 0 hops from itself and an
    unreachable one has no row. The search runs from the landmarks against the edges, so
    its work is set by what can reach them.
    """
    scratch = Scratch(graph.spark, "hops")
    turned = graph.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    against = scratch.write_bucketed(turned, "src").df
    seeds = (
        graph.vertices.select("id")
        .join(landmarks.select("id"), "id", "left_semi")
        .select("id", F.col("id").alias("landmark"))
    )
    return reach(scratch, against, seeds, ("landmark",)).withColumnRenamed("val", "distance")


def distance_maps(distances: DataFrame) -> DataFrame:
    """``(id, distances map<landmark, hops>)`` for a set of landmarks that fits a row."""
    return distances.groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("landmark", "distance"))).alias("distances")
    )


def reachable_from(graph: FormulaGraph, root_id) -> DataFrame:
    """``(id, distance)`` of the root and everything below it."""
    scratch = Scratch(graph.spark, "reach")
    start = _start(scratch, graph, root_id)
    edges = scratch.write_bucketed(graph.edges, "src").df.select("src", "dst")
    return reach(scratch, edges, start).withColumnRenamed("val", "distance")


def _start(scratch: Scratch, graph: FormulaGraph, root_id) -> DataFrame:
    start = scratch.write(graph.vertices.where(F.col("id") == root_id).select("id"))
    if not start.rows:
        raise GraphError(f"no vertex {root_id!r}")
    return start.df


def reachable_subgraph(graph: FormulaGraph, root_id) -> FormulaGraph:
    """The graph below ``root_id``, itself included, without isolated vertices.

    An edge out of a reached vertex ends in a reached vertex, so one semi join gives the
    induced edges. Only a root without any edge can be isolated. A search that is not through
    after ``SEARCH_ROUNDS`` rounds goes on by ranges of ids: see :mod:`rootwise.operators.ranges`.
    """
    scratch = Scratch(graph.spark, "subgraph")
    written = scratch.write_bucketed(graph.edges, "src").df
    links = written.select("src", "dst")
    start = _start(scratch, graph, root_id).select("id", F.lit(0).alias("val"))
    reached, fresh = spread_rounds(scratch, links, start, "val + 1", (), True, SEARCH_ROUNDS)
    if fresh is not None:
        reached = reach_by_ranges(scratch, links, reached, fresh)
    reached = scratch.write(reached.select("id")).df
    edges = written.join(reached.withColumnRenamed("id", "src"), "src", "left_semi")
    edges = edges.select(*graph.edges.columns)
    vertices = graph.vertices.join(reached, "id", "left_semi")
    return replace(graph, vertices=vertices, edges=edges).drop_isolated()


def shortest_distances(edges: DataFrame, source_id) -> DataFrame:
    """``(id, distance)`` of all reached from ``source_id`` over ``edges(src, dst, weight)``.

    Weights are non-negative; vertices without a row are unreachable.
    """
    weighted = edges.select("src", "dst", F.col("weight").cast("double").alias("weight"))
    odd = F.col("weight").isNull() | F.isnan("weight") | (F.col("weight") < 0)
    scratch = Scratch(edges.sparkSession, "sssp")
    # Parallel edges stay: the search takes the least anyway, and merging them would shuffle and sort all edges once more.
    table = scratch.write_bucketed(weighted, "src", odd=F.count_if(odd))
    if table.counts["odd"]:
        raise GraphError(f"{table.counts['odd']} edges have a missing or negative weight")
    kind = edges.schema["src"].dataType
    seeds = edges.sparkSession.range(1).select(
        F.lit(source_id).cast(kind).alias("id"), F.lit(0.0).alias("val")
    )
    found = spread_min(scratch, table.df, seeds, "val + weight", settled=False)
    return found.withColumnRenamed("val", "distance")


def with_distances(vertices: DataFrame, distances: DataFrame) -> DataFrame:
    """Every vertex with its ``distance``, NULL where there is none."""
    return vertices.join(distances, "id", "left")
