"""The graph: a vertex table and an edge table."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROOT_ID = "r00t"


class GraphError(ValueError):
    """The tables do not form the graph an operator needs."""


@dataclass(frozen=True)
class FormulaGraph:
    """``vertices(id, ...)`` and ``edges(src, dst, ...)``, each edge parent to dependant.

    ``edges_from_text`` says that the edges were derived from the formula texts, so a
    text reference to an existing vertex is known to have its edge; ``pieces`` are those
    texts cut at their references, where that has been done.
    """

    vertices: DataFrame
    edges: DataFrame
    root_id: str = ROOT_ID
    edges_from_text: bool = False
    pieces: DataFrame | None = None

    @property
    def spark(self):
        return self.vertices.sparkSession

    def problems(self) -> DataFrame:
        """``(problem, id, n)``: repeated vertex ids and edge ends that are no vertex."""
        uses = (
            self.vertices.select("id", F.lit(1).alias("as_vertex"), F.lit(0).alias("as_end"))
            .unionByName(self.edges.select(F.col("src").alias("id"), F.lit(0).alias("as_vertex"), F.lit(1).alias("as_end")))
            .unionByName(self.edges.select(F.col("dst").alias("id"), F.lit(0).alias("as_vertex"), F.lit(1).alias("as_end")))
            .groupBy("id")
            .agg(F.sum("as_vertex").alias("as_vertex"), F.sum("as_end").alias("as_end"))
        )
        repeated = F.col("as_vertex") > 1
        return uses.where(repeated | (F.col("as_vertex") == 0)).select(
            F.when(repeated, "duplicate_id").otherwise("dangling_end").alias("problem"),
            "id",
            F.when(repeated, F.col("as_vertex")).otherwise(F.col("as_end")).alias("n"),
        )

    def validate(self) -> "FormulaGraph":
        """Return the graph, or raise with up to five of its problems."""
        found = self.problems().take(5)
        if found:
            raise GraphError(f"invalid graph: {[(r.problem, r.id, r.n) for r in found]}")
        return self

    def filter_vertices(self, condition: Column | str) -> "FormulaGraph":
        """Induced subgraph of the vertices that meet ``condition``."""
        return self.induced(self.vertices.where(condition))

    def induced(self, ids: DataFrame) -> "FormulaGraph":
        """Vertices whose id is in ``ids(id)`` and the edges between them."""
        ids = ids.select("id")
        return replace(
            self,
            vertices=self.vertices.join(ids, "id", "left_semi"),
            edges=self.edges.join(ids.select(F.col("id").alias("src")), "src", "left_semi")
            .join(ids.select(F.col("id").alias("dst")), "dst", "left_semi")
            .select(*self.edges.columns),
        )

    def drop_isolated(self) -> "FormulaGraph":
        """Only the vertices at some end of an edge; a self-loop counts."""
        ends = self.edges.select(F.col("src").alias("id")).unionByName(
            self.edges.select(F.col("dst").alias("id"))
        )
        return replace(self, vertices=self.vertices.join(ends.distinct(), "id", "left_semi"))
