"""Cycles: strongly connected components, self-loops, and all they affect."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.model import FormulaGraph
from rootwise.operators import ranges
from rootwise.operators.doubling import rings, way_ends
from rootwise.operators.ranges import components_inside
from rootwise.operators.spread import reach, spread_min
from rootwise.scratch import RoundTable, Scratch

SELF_SUFFIX = "#self"


# What a round of trimming or contracting must take off the edges to be worth another, as a divisor.
WORTH = 8


def strong_components(scratch: Scratch, edges: DataFrame) -> RoundTable | None:
    """``(cycle_id, id)`` of the components with two or more vertices; None without any.

    ``cycle_id`` is the smallest id inside. Vertices without a live edge in and one out are on no cycle: they
    are trimmed. A chain of vertices with one edge in and one out becomes an edge between its ends, and the
    chain belongs to the component that has both; rings of such vertices are components. Both go on while they
    shrink the graph; a chain of any length is gone after as many rounds as that has digits. Colours
    decide what is left: see :func:`_coloured`. Before, components inside a range of ids become one vertex each.
    """
    live = scratch.write(edges.where("src <> dst").select("src", "dst").distinct())
    parts: list[RoundTable] = []
    chains: list[tuple[RoundTable, RoundTable]] = []
    live = _trimmed(scratch, live)
    live, merged = _merged(scratch, live)
    while live.rows:
        before = live.rows
        live, contracted = _contracted(scratch, live, parts)
        if contracted is None:
            break
        chains.append(contracted)
        live = _trimmed(scratch, live)
        if before - live.rows < before // WORTH:
            break
    if live.rows:
        parts.append(_coloured(scratch, live))
    if not parts and not chains and not merged:
        return None
    none = scratch.write(edges.select(F.col("src").alias("id"), F.col("src").alias("low")).where("false"))
    members = scratch.scan([none, *parts])
    for chain, back in reversed(chains):
        # A vertex that a chain leads back to is a component with it, if it is in no other.
        alone = back.df.join(members.select("id"), "id", "left_anti")
        members = members.unionByName(alone.select("id", F.col("id").alias("low")))
        both = chain.df.join(members.toDF("low", "above"), F.col("low") == F.col("head")).drop("low")
        both = both.join(members.toDF("low", "below"), F.col("low") == F.col("tail")).where("above = below")
        members = scratch.write(members.unionByName(both.select("id", F.col("above").alias("low")))).df
    for inside in reversed(merged):
        # What one vertex stood for goes where that went.
        own = inside.df.join(members.toDF("low", "outer"), "low", "left").select("id", F.coalesce("outer", "low").alias("low"))
        members = own.unionByName(members.join(inside.df.select("id"), "id", "left_anti"))
        members = scratch.write(members).df
    sizes = members.groupBy("low").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("cycle_id")).where("n > 1")
    found = scratch.write(members.join(sizes, "low").select("cycle_id", "id"))
    return found if found.rows else None


def _merged(scratch: Scratch, live: RoundTable) -> tuple[RoundTable, list[RoundTable]]:
    """The edges left when components inside ranges are one vertex each, the smallest id; and their vertices ``(id, low)``.

    Fewer edges have fewer ranges, so it goes on while the graph shrinks. All components are inside a single range.
    """
    merged: list[RoundTable] = []
    while live.rows:
        before = live.rows
        inside = components_inside(scratch, live)
        if inside.rows:
            merged.append(inside)
        if before <= ranges.RANGE_EDGES:
            return scratch.write(live.df.where("false")), merged
        if not inside.rows:
            break
        ends = live.df.join(inside.df.toDF("src", "from"), "src", "left").join(inside.df.toDF("dst", "to"), "dst", "left")
        ends = ends.select(F.coalesce("from", "src").alias("src"), F.coalesce("to", "dst").alias("dst"))
        between = scratch.write(ends.where("src <> dst").distinct())
        scratch.drop(live)
        live = _trimmed(scratch, between)
        if before - live.rows < before // WORTH:
            break
    return live, merged


def _trimmed(scratch: Scratch, live: RoundTable) -> RoundTable:
    """The edges whose source has an edge in and whose target has one out, again and again."""
    while live.rows:
        into, out = live.df.select(F.col("dst").alias("src")), live.df.select(F.col("src").alias("dst"))
        rest = live.df.join(into.distinct(), "src", "left_semi").join(out.distinct(), "dst", "left_semi")
        left = scratch.write(rest.select("src", "dst"))
        gone = live.rows - left.rows
        scratch.drop(live)
        live = left
        if gone <= left.rows // WORTH:
            break
    return live


def _contracted(
    scratch: Scratch, live: RoundTable, parts: list[RoundTable]
) -> tuple[RoundTable, tuple[RoundTable, RoundTable] | None]:
    """The edges with chains as single ones; the chains' vertices ``(id, head, tail)`` and those that one leads back to.

    There is only the first if chains are few. Rings go to ``parts`` as ``(id, low)``.
    """
    uses = live.df.select(F.col("src").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        live.df.select(F.col("dst").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    single = uses.groupBy("id").agg(F.sum("out").alias("out"), F.sum("into").alias("into")).where("out = 1 and into = 1")
    mids = scratch.write(single.select("id"))
    if mids.rows <= live.rows // WORTH:
        return live, None
    down = scratch.write(live.df.join(mids.df.withColumnRenamed("id", "src"), "src").toDF("id", "to"))
    up = live.df.join(mids.df.withColumnRenamed("id", "dst"), "dst").select(F.col("dst").alias("id"), F.col("src").alias("to"))
    tails, endless = way_ends(scratch, down.df)
    tails = scratch.write(tails.drop("steps"))
    if tails.rows < down.rows:
        round_ = down.df.join(tails.df, "id", "left_anti")
        parts.append(scratch.write(rings(scratch, round_, down.rows - tails.rows).select("id", "low")))
    heads, _ = way_ends(scratch, scratch.write(up.join(tails.df, "id", "left_semi")).df)
    chain = scratch.write(heads.join(tails.df.withColumnRenamed("end", "tail"), "id").select("id", F.col("end").alias("head"), "tail"))
    plain = live.df.join(mids.df.withColumnRenamed("id", "src"), "src", "left_anti")
    through = plain.join(chain.df.select(F.col("id").alias("dst"), "tail"), "dst", "left")
    joined = scratch.write(through.select("src", F.coalesce("tail", "dst").alias("dst")).distinct())
    back = scratch.write(joined.df.where("src = dst").select(F.col("src").alias("id")))
    rest = scratch.write(joined.df.where("src <> dst"))
    scratch.drop(live, joined)
    return rest, (chain, back)


def _coloured(scratch: Scratch, live: RoundTable) -> RoundTable:
    """``(id, low)``: every vertex with a label that it shares with its component only.

    Every vertex takes two colours in one search: the smallest id that reaches it and the smallest it
    reaches. Where both are the same, that vertex is on a way there and back, so these are that id's
    component. A component has one pair of colours, so the rest goes round again with the edges inside
    a pair only.
    """
    found: list[RoundTable] = []
    while live.rows:
        forth = live.df.select("src", "dst", F.lit(True).alias("forth"))
        back = live.df.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(False).alias("forth"))
        both = forth.unionByName(back).select(
            F.struct("forth", F.col("src").alias("id")).alias("src"),
            F.struct("forth", F.col("dst").alias("id")).alias("dst"),
        )
        seeds = both.select(F.explode(F.array("src", "dst")).alias("id")).select("id", F.col("id.id").alias("val"))
        seen = spread_min(scratch, both, seeds, "val", settled=False)
        from_, to = (F.max(F.when(F.col("id.forth") == way, F.col("val"))) for way in (True, False))
        colours = scratch.write(
            seen.groupBy(F.col("id.id").alias("id")).agg(from_.alias("low"), to.alias("high"))
        )
        found.append(colours)
        open_ = colours.df.where("low <> high")
        rest = (
            live.df.join(open_.toDF("src", "low", "high"), "src")
            .join(open_.toDF("dst", "low", "high"), ["dst", "low", "high"])
            .select("src", "dst")
        )
        inside = _trimmed(scratch, scratch.write(rest))
        scratch.drop(live)
        live = inside
    return scratch.write(scratch.scan(found).where("low = high").select("id", "low"))


@dataclass(frozen=True)
class CycleGroups:
    """``members(cycle_id, id)`` and ``edges(cycle_id, src, dst)`` of every cycle group."""

    members: DataFrame
    edges: DataFrame


def self_loops(graph: FormulaGraph) -> DataFrame:
    """Vertices with an edge to themselves."""
    loops = graph.edges.where("src = dst").select(F.col("src").alias("id")).distinct()
    return graph.vertices.join(loops, "id", "left_semi")


def cycle_groups(graph: FormulaGraph) -> CycleGroups:
    """One group per strongly connected component of two or more, one per self-loop.

    ``cycle_id`` is the smallest id of the group as text, with ``#self`` behind it for a
    self-loop, so that a self-looping vertex inside a larger component has both groups.
    """
    scratch = Scratch(graph.spark, "cycles")
    edges = scratch.write(graph.edges.select("src", "dst")).df
    loops = (
        edges.where("src = dst")
        .distinct()
        .select(F.concat(F.col("src").cast("string"), F.lit(SELF_SUFFIX)).alias("cycle_id"), "src", "dst")
    )
    loop_members = loops.select("cycle_id", F.col("src").alias("id"))
    groups = strong_components(scratch, edges)
    if groups is None:
        return CycleGroups(loop_members, loops)
    members = groups.df.select(F.col("cycle_id").cast("string").alias("cycle_id"), "id")
    inner = (
        edges.join(members.withColumnRenamed("id", "src"), "src")
        .join(members.withColumnRenamed("id", "dst"), ["dst", "cycle_id"])
        .select("cycle_id", "src", "dst")
    )
    return CycleGroups(members.unionByName(loop_members), inner.unionByName(loops))


def cycle_affected(graph: FormulaGraph, groups: CycleGroups) -> CycleGroups:
    """For every cycle group, all that is reachable from it, with the edges in between.

    One search keyed by ``cycle_id`` serves all groups; it starts at one member of each,
    as any member reaches the same vertices.
    """
    scratch = Scratch(graph.spark, "affected")
    seeds = groups.members.groupBy("cycle_id").agg(F.min("id").alias("id"))
    edges = scratch.write_bucketed(graph.edges.select("src", "dst"), "src").df
    reached = scratch.write(
        reach(scratch, edges, seeds.select("id", "cycle_id"), ("cycle_id",)).select("cycle_id", "id")
    ).df
    inner = edges.join(reached.withColumnRenamed("id", "src"), "src").select("cycle_id", "src", "dst")
    return CycleGroups(reached, inner)


def affected_by_any(graph: FormulaGraph, groups: CycleGroups) -> FormulaGraph:
    """All that some cycle reaches, once each, whichever and however many cycles those are."""
    scratch = Scratch(graph.spark, "affected-any")
    edges = scratch.write_bucketed(graph.edges.select("src", "dst"), "src").df
    seeds = groups.members.select("id").distinct()
    reached = scratch.write(reach(scratch, edges, seeds).select("id")).df
    return FormulaGraph(
        graph.vertices.join(reached, "id", "left_semi"),
        edges.join(reached.withColumnRenamed("id", "src"), "src", "left_semi"),
        graph.root_id,
    )


def with_vertices(graph: FormulaGraph, members: DataFrame) -> DataFrame:
    """``members(cycle_id, id)`` with the columns of their vertices."""
    return members.join(graph.vertices, "id").select("cycle_id", *graph.vertices.columns)
