"""From a table of formulas to a graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.functions.text import has_opening, is_standalone, mentioned_ids, reference_pieces
from rootwise.model import ROOT_ID, FormulaGraph
from rootwise.scratch import Scratch


def add_root(vertices: DataFrame, root_id: str = ROOT_ID) -> DataFrame:
    """``vertices`` plus the artificial root row; columns it does not know are NULL.

    A vertex that already has the root's id fails the job that reads it; no job looks for one.
    """
    taken = F.raise_error(F.lit(f"the id {root_id!r} is already in use")).cast("string")
    kind = vertices.schema["id"].dataType
    checked = F.when(F.col("id") == root_id, taken.cast(kind)).otherwise(F.col("id"))
    vertices = vertices.withColumn("id", checked)
    known = {
        "id": F.lit(root_id),
        "name": F.lit("root"),
        "formula": F.lit(""),
        "value": F.lit(0),
    }
    root = vertices.sparkSession.range(1).select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in vertices.schema]
    )
    return vertices.unionByName(root)


def text_pieces(vertices: DataFrame) -> DataFrame:
    """``(id, pos, lead, ref, tail)``: the texts with references, cut at each of them."""
    cut = F.inline(reference_pieces(F.col("formula")))
    return vertices.where(has_opening(F.col("formula"))).select("id", cut)


def reference_edges(vertices: DataFrame) -> DataFrame:
    """``(dst, src)``: one row for each vertex ``src`` that ``dst``'s formula refers to.

    The texts are read once and cut where they are; only the id pairs are shuffled, to
    keep those whose ``src`` is a vertex.
    """
    mentions = vertices.select(
        F.col("id").alias("dst"), F.explode(mentioned_ids(F.col("formula"))).alias("src")
    )
    ids = vertices.select(F.col("id").alias("src"))
    return mentions.join(ids, "src", "left_semi").select("dst", "src")


def root_edges(vertices: DataFrame, root_id: str = ROOT_ID) -> DataFrame:
    """``(dst, src)``: root to every formula without references."""
    return vertices.where((F.col("id") != root_id) & is_standalone(F.col("formula"))).select(
        F.col("id").alias("dst"), F.lit(root_id).alias("src")
    )


def collect_edges(vertices: DataFrame, root_id: str = ROOT_ID) -> DataFrame:
    """All edges of a formula table that already has its root, as ``(dst, src)``."""
    return root_edges(vertices, root_id).unionByName(reference_edges(vertices))


def formula_graph(formulas: DataFrame, root_id: str = ROOT_ID) -> FormulaGraph:
    """Graph of a table ``(id, formula, ...)``: root added, edges taken from the texts."""
    vertices = add_root(formulas, root_id)
    # The texts are cut once; edges, evaluation and arguments all go back to the pieces.
    pieces = Scratch(formulas.sparkSession, "pieces").write(text_pieces(vertices)).df
    ids = vertices.select(F.col("id").alias("src"))
    mentions = pieces.where("ref is not null").select(F.col("ref").alias("src"), F.col("id").alias("dst")).distinct()
    edges = mentions.join(ids, "src", "left_semi").unionByName(root_edges(vertices, root_id))
    return FormulaGraph(vertices, edges.select("src", "dst"), root_id, True, pieces)
