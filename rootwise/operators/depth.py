"""Depth below the root: the longest path, with an answer for cyclic input too."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.model import FormulaGraph
from rootwise.operators.cycles import strong_components
from rootwise.operators.doubling import way_ends
from rootwise.operators.peel import Peeled, in_degrees, peel, with_need
from rootwise.operators.spread import reach
from rootwise.scratch import RoundTable, Scratch

REACHED = "reached"
UNREACHABLE = "unreachable"
CYCLIC = "cyclic"
BELOW_CYCLE = "below_cycle"

# Chains are contracted if they hold more than this part of the vertices, as a divisor.
WORTH = 8


@dataclass(frozen=True)
class DepthTable:
    """``(id, depth, state)`` as a round table, with what the driver knows about it."""

    table: RoundTable
    deepest: int
    unbounded: int

    @property
    def df(self) -> DataFrame:
        return self.table.df


def depth_from_root(graph: FormulaGraph) -> DataFrame:
    """``(id, depth, state)``: root 0, else one more than the deepest reached parent.

    ``state`` is ``reached``, ``unreachable`` (from the root), ``cyclic`` (on a reachable
    cycle) or ``below_cycle``; only reached vertices have a depth.
    """
    return depth_table(graph, Scratch(graph.spark, "depth")).df


def depth_table(graph: FormulaGraph, scratch: Scratch) -> DepthTable:
    plain = graph.edges.select("src", "dst")
    # The edges are used twice here; derived from texts, they are worth keeping.
    kept = scratch.write(plain).df if graph.edges_from_text else plain
    is_root = F.col("id") == graph.root_id
    is_link = F.coalesce((F.col("need") == 1) & (F.col("uses") == 1), F.lit(False)) & ~is_root
    needs = scratch.write(
        in_degrees(graph.vertices, kept).join(_uses(kept), "id", "left").select("id", "need", is_link.alias("link")),
        free=F.count_if(F.col("need") == 0),
        links=F.count_if("link"),
    )
    start = needs.df.where("need = 0").select("id", F.when(is_root, F.lit(0)).alias("depth"))
    if needs.counts["links"] > needs.rows // WORTH:
        first = _peeled_by_chains(scratch, kept, needs.df, start, needs.counts["free"], graph.root_id)
        edges = kept
    else:
        table = scratch.write_bucketed(with_need(kept, needs.df), "src")
        first = peel(scratch, table, start, needs.counts["free"], root_id=graph.root_id)
        edges = table.df
    parts = [_settled(first.done)]
    if first.rows < needs.rows:
        parts += _held_up(graph, scratch, edges, needs.df, first)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    table = scratch.write(
        out,
        deepest=F.max("depth"),
        unbounded=F.count_if(F.col("state").isin(CYCLIC, BELOW_CYCLE)),
    )
    return DepthTable(table, table.counts["deepest"], table.counts["unbounded"])


def _uses(edges: DataFrame) -> DataFrame:
    """``(id, uses)``: the number of out-edges, of vertices that have some."""
    return edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("uses"))


def _peeled_by_chains(scratch: Scratch, edges: DataFrame, needs: DataFrame, start: DataFrame, free: int, root_id) -> Peeled:
    """The peel, with each chain of ``link`` vertices as one edge of as many steps.

    A link has one edge in and one out, so its depth is that of the vertex its chain hangs from and the
    steps from there; doubling finds both in as many rounds as the longest chain has digits. The core is
    peeled, the chains are filled in. What waits afterwards waits in the graph as it was too: the last
    link of a chain tells its target what the chain's edge does. Rings of links are never finished.
    """
    links = needs.where("link").select("id")
    up = edges.select(F.col("dst").alias("id"), F.col("src").alias("to")).join(links, "id", "left_semi")
    hung, _ = way_ends(scratch, up)
    hung = scratch.write(hung).df
    among_core = edges.join(links.toDF("dst"), "dst", "left_anti")
    core = among_core.join(hung.select(F.col("id").alias("src"), "end", F.col("steps").alias("chain")), "src", "left").select(
        F.coalesce("end", "src").alias("src"), "dst", (F.coalesce("chain", F.lit(0)) + 1).alias("steps")
    )
    table = scratch.write_bucketed(with_need(core, needs.select("id", "need")), "src")
    peeled = peel(scratch, table, start, free, root_id=root_id)
    filled = scratch.write(
        hung.join(peeled.done.withColumnRenamed("id", "end"), "end").select(
            "id", (F.col("depth") + F.col("steps")).cast("int").alias("depth")
        )
    )
    return Peeled(peeled.done.unionByName(filled.df), peeled.waiting, peeled.rows + filled.rows)


def _settled(done: DataFrame) -> DataFrame:
    state = F.when(F.col("depth").isNull(), UNREACHABLE).otherwise(REACHED)
    return done.select("id", "depth", state.alias("state"))


def _held_up(graph, scratch, edges, needs, first) -> list[DataFrame]:
    """The vertices on or below some cycle, reachable or not.

    A parent that the root does not reach sends nothing, so it must not hold anything up:
    the peel goes on over the part that is reached. What then still waits has a reachable
    cycle above it.
    """
    left = scratch.write(needs.select("id").join(first.done.select("id"), "id", "left_anti"))
    among = scratch.write_bucketed(
        edges.join(left.df.withColumnRenamed("id", "src"), "src", "left_semi").select("src", "dst"), "src"
    )
    heard = left.df.where(F.col("id") == graph.root_id).select("id", F.lit(0).alias("depth"))
    if first.waiting is not None:
        told = first.waiting.where("depth is not null").select("id", "depth")
        heard = heard.unionByName(told).groupBy("id").agg(F.max("depth").alias("depth"))
    heard = scratch.write(heard).df
    reached = scratch.write(reach(scratch, among.df, heard).select("id"))
    inner = scratch.write(
        among.df.join(reached.df.withColumnRenamed("id", "src"), "src", "left_semi").select("src", "dst")
    )
    again = scratch.write(
        in_degrees(reached.df, inner.df).join(heard, "id", "left"),
        free=F.count_if(F.col("need") == 0),
    )
    onward = scratch.write_bucketed(with_need(inner.df, again.df.select("id", "need")), "src")
    start = again.df.where("need = 0").select("id", "depth")
    waiting = again.df.where("need > 0 and depth is not null").select(
        "id", "need", F.lit(0).cast("long").alias("got"), "depth"
    )
    second = peel(scratch, onward, start, again.counts["free"], waiting, graph.root_id)
    no_depth = F.lit(None).cast("int").alias("depth")
    unreached = left.df.join(reached.df, "id", "left_anti")
    parts = [
        _settled(second.done),
        unreached.select("id", no_depth, F.lit(UNREACHABLE).alias("state")),
    ]
    if second.rows < reached.rows:
        stuck = scratch.write(reached.df.join(second.done.select("id"), "id", "left_anti")).df
        tied = scratch.write(
            inner.df.join(stuck.withColumnRenamed("id", "src"), "src", "left_semi").select("src", "dst")
        ).df
        on_cycle = tied.where("src = dst").select(F.col("src").alias("id"))
        groups = strong_components(scratch, tied)
        if groups is not None:
            on_cycle = on_cycle.unionByName(groups.df.select("id"))
        on_cycle = on_cycle.distinct().withColumn("state", F.lit(CYCLIC))
        parts.append(
            stuck.join(on_cycle, "id", "left").select(
                "id", no_depth, F.coalesce("state", F.lit(BELOW_CYCLE)).alias("state")
            )
        )
    return parts
