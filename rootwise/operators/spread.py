"""Spread the smallest value along edges until nothing improves.

Reachability, hop counts, weighted distances and component colours are all this: each
round joins only the rows that improved with the edges, takes the minimum per target,
and keeps what beats the value known so far. Known values are an append-only list of
round tables. A round goes a fixed number of edges far, which share one shuffle of the edges where
one is needed. What it tries is written before it meets the known rows: the planner then
knows its size, and known rows are neither sorted nor shuffled for a round of few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.scratch import RoundTable, Scratch

# Edges that a round goes far. A row may be looked at again for nothing inside a round only; where more rows
# than ``FEW`` go on, or were reached by the round before, that costs more than a round: it goes one edge far.
HOPS = 3
FEW = 50_000
# Round tables to pile up before they are merged into one.
MERGE_EVERY = 24


def spread_min(
    scratch: Scratch,
    edges: DataFrame,
    seeds: DataFrame,
    step: str,
    labels: tuple[str, ...] = (),
    settled: bool = True,
) -> DataFrame:
    """Smallest ``val`` per ``(id, *labels)`` reached from ``seeds(id, *labels, val)``.

    ``edges(src, dst, ...)`` is read every round, so it should be a table written in buckets of ``src``:
    then no round shuffles it. ``step`` is the SQL expression of the value at ``dst`` from ``val`` at ``src``, and may use edge
    columns. ``settled`` says that the first value a row gets is final, as with hop counts;
    otherwise values may improve in later rounds.
    """
    return spread_rounds(scratch, edges, seeds, step, labels, settled)[0]


def spread_rounds(
    scratch: Scratch, edges: DataFrame, seeds: DataFrame, step: str, labels: tuple[str, ...], settled: bool, most: int | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """:func:`spread_min` in ``most`` rounds; also the rows that are still to go on then, None if there are none."""
    keys = ["id", *labels]
    first = scratch.write(seeds.groupBy(*keys).agg(F.min("val").alias("val")))
    known, newest = [first], first
    fresh, fresh_rows, rounds, touched = first.df, first.rows, 0, first.rows
    while fresh_rows:
        if rounds == most:
            return _best(scratch.scan(known).select(*keys, "val"), keys, settled), fresh
        rounds += 1
        hops = HOPS if max(fresh_rows, touched) <= FEW else 1
        tried = scratch.write(_hops(edges, fresh.select(*keys, "val"), step, labels, hops))
        touched = tried.rows
        scratch.drop_unless(known, newest)
        if not tried.rows:
            scratch.drop(tried)
            break
        rows = scratch.scan(known).select(*keys, "val").join(tried.df.select(*keys), keys, "left_semi")
        best = _best(rows, keys, settled).withColumnRenamed("val", "old")
        better = tried.df.join(best, keys, "left").where("old IS NULL OR val < old")
        newest = scratch.write(better.select(*keys, "val", "fresh"), fresh=F.count_if("fresh"))
        scratch.drop(tried)
        fresh, fresh_rows = newest.df.where("fresh"), newest.counts["fresh"]
        known.append(newest)
        if len(known) > MERGE_EVERY:
            merged = scratch.write(_best(scratch.scan(known).select(*keys, "val"), keys, settled))
            scratch.drop(*known[:-1])
            known = [merged]
    return _best(scratch.scan(known).select(*keys, "val"), keys, settled), None


def _hops(edges: DataFrame, fresh: DataFrame, step: str, labels: tuple[str, ...], hops: int) -> DataFrame:
    """What ``fresh`` gives the vertices up to ``hops`` edges on.

    ``fresh`` is then true for rows that got their value from the last edge: theirs are still to go.
    """
    keys = ["id", *labels]
    kind = fresh.schema["val"].dataType
    out = None
    for hop in range(1, hops + 1):
        start = fresh.withColumnRenamed("id", "src")
        # Without labels there is one row a vertex: a bucket's rows fit a hash table, and the edges need no sorting.
        moved = edges.join(start if labels else start.hint("shuffle_hash"), "src").select(
            F.col("dst").alias("id"), *labels, F.expr(step).cast(kind).alias("val")
        )
        fresh = moved.groupBy(*keys).agg(F.min("val").alias("val"))
        tagged = fresh.withColumn("last", F.lit(hop == hops))
        out = tagged if out is None else out.unionByName(tagged)
    early, late = (F.min(F.when(F.col("last") == last, F.col("val"))) for last in (False, True))
    least = out.groupBy(*keys).agg(early.alias("early"), late.alias("late"))
    going = F.col("early").isNull() | (F.col("late") < F.col("early"))
    return least.select(*keys, F.least("early", "late").alias("val"), F.coalesce(going, F.lit(False)).alias("fresh"))


def _best(rows: DataFrame, keys: list[str], settled: bool) -> DataFrame:
    return rows if settled else rows.groupBy(*keys).agg(F.min("val").alias("val"))


def reach(
    scratch: Scratch, edges: DataFrame, seeds: DataFrame, labels: tuple[str, ...] = ()
) -> DataFrame:
    """``(id, *labels, val)`` for all reached from ``seeds(id, *labels)``; ``val`` is hops."""
    start = seeds.select("id", *labels, F.lit(0).alias("val"))
    return spread_min(scratch, edges, start, "val + 1", labels)
