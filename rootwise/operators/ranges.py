"""Work by ranges of ids: a task does all that lies inside its range; what crosses is left to rounds.

The edges are written in ranges of their source, of bounded size. A round of a search reads the ranges that were newly
entered; each finds all it leads to over its own edges, however many hops that takes. Rounds count crossings
between ranges instead of hops: few where edges mostly lead to ids that are near in order, never more
than the hops. Components inside a range are found the same way: each is part of one of the whole graph.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.scratch import RoundTable, Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Edges in a range, in the mean: some 20 MB of ids.
RANGE_EDGES = 500_000
# Tables of reached vertices to pile up before they are merged into one.
MERGE_EVERY = 24

_EDGE, _OLD, _FRESH = 0, 1, 2


def reach_by_ranges(scratch: Scratch, edges: DataFrame, known: DataFrame, fresh: DataFrame) -> DataFrame:
    """``(id)`` of all that ``edges(src, dst)`` lead to from ``known(id)``, themselves included.

    ``fresh(id)`` are those of ``known`` whose edges have not been followed yet.
    """
    rows = scratch.write(edges.select("src", "dst"))
    ranges = max(1, -(-rows.rows // RANGE_EDGES))
    spread = rows.df.repartitionByRange(ranges, "src", "dst").withColumn("range", F.spark_partition_id())
    parts = scratch.write(spread, partition_by=("range",)).df
    scratch.drop(rows)
    # A vertex with many edges may lie in several ranges; one without any is in none, range NULL.
    homes = scratch.write(parts.select(F.col("src").alias("id"), "range").distinct()).df
    begun = known.select("id").distinct().join(fresh.select("id").distinct().withColumn("new", F.lit(True)), "id", "left")
    begun = begun.join(homes, "id", "left").select("id", "range", F.coalesce("new", F.lit(False)).alias("fresh"))
    newest = _write(scratch, begun)
    told = [newest]
    while newest.counts["entered"]:
        entered = F.col("range").isin(newest.counts["entered"])
        old = scratch.scan(told).where(entered).groupBy("id", "range").agg(F.max(F.col("fresh")).alias("fresh"))
        new = newest.df.where("fresh and range is not null").select("id", "range").withColumn("new", F.lit(True))
        served = old.join(new, ["id", "range"], "left").select(
            "range", F.col("id").alias("src"), F.lit(None).cast(edges.schema["dst"].dataType).alias("dst"),
            F.when(F.col("new"), _FRESH).otherwise(_OLD).alias("kind"),
        )
        inside = parts.where(entered).select("range", "src", "dst", F.lit(_EDGE).alias("kind"))
        found = inside.unionByName(served).groupBy("range").applyInArrow(_followed, f"id {edges.schema['dst'].dataType.simpleString()}, range int")
        found = scratch.write(found)
        # Every home of what was found; where a range has found its own, it has followed its edges as well.
        ends = found.df.withColumnRenamed("range", "by").join(homes, "id", "left")
        foreign = F.col("range").isNotNull() & (F.col("by") != F.col("range"))
        ends = ends.groupBy("id", "range").agg(F.min(foreign).alias("fresh"))
        seen = scratch.scan(told).select(F.col("id").alias("known"), F.col("range").alias("in"))
        same = (F.col("id") == F.col("known")) & F.col("range").eqNullSafe(F.col("in"))
        newest = _write(scratch, ends.join(seen, same, "left_anti"))
        scratch.drop(found)
        told.append(newest)
        if len(told) > MERGE_EVERY:
            merged = scratch.write(scratch.scan(told))
            scratch.drop(*told[:-1])
            told = [merged]
    return scratch.scan(told).select("id").distinct()


def _write(scratch: Scratch, rows: DataFrame) -> RoundTable:
    """``rows(id, range, fresh)``, with the ranges that something fresh is in."""
    return scratch.write(rows, entered=F.collect_set(F.when(F.col("fresh"), F.col("range"))))


def _followed(group: pa.Table) -> pa.Table:
    """``(id, range)``: what the fresh vertices of a range lead to over its edges, without those known in it."""
    kind = group["kind"].to_numpy()
    is_edge = kind == _EDGE
    names = pa.concat_arrays([
        group["src"].combine_chunks(), group["dst"].filter(pa.array(is_edge)).combine_chunks(),
    ]).dictionary_encode()
    at = names.indices.to_numpy()
    first, dst = at[: len(kind)], at[len(kind) :]
    order = np.argsort(first[is_edge], kind="stable")
    dst = dst[order]
    begin = np.searchsorted(first[is_edge][order], np.arange(len(names.dictionary) + 1))
    seen = np.zeros(len(names.dictionary), bool)
    seen[first[~is_edge]] = True
    before = seen.copy()
    front = first[kind == _FRESH]
    while len(front):
        sizes = begin[front + 1] - begin[front]
        edges = np.arange(sizes.sum()) + np.repeat(begin[front] - np.cumsum(sizes) + sizes, sizes)
        front = np.unique(dst[edges])
        front = front[~seen[front]]
        seen[front] = True
    new = np.flatnonzero(seen & ~before)
    here = pa.array(np.full(len(new), group["range"][0].as_py(), np.int32))
    return pa.table({"id": names.dictionary.take(pa.array(new)), "range": here})


def components_inside(scratch: Scratch, edges: RoundTable) -> RoundTable:
    """``(id, low)``: vertices that are on a cycle inside their range, and the smallest id of their component there.

    A vertex whose edges lie in several ranges belongs to the first.
    """
    ranges = max(1, -(-edges.rows // RANGE_EDGES))
    spread = edges.df.repartitionByRange(ranges, "src", "dst").withColumn("range", F.spark_partition_id())
    parts = scratch.write(spread)
    homes = parts.df.groupBy("src").agg(F.min("range").alias("range"))
    inside = parts.df.join(homes, ["src", "range"], "left_semi")
    inside = inside.join(homes.withColumnRenamed("src", "dst"), ["dst", "range"], "left_semi").select("range", "src", "dst")
    kind = edges.schema["src"].dataType.simpleString()
    found = scratch.write(inside.groupBy("range").applyInArrow(_components, f"id {kind}, low {kind}"))
    scratch.drop(parts)
    return found


def _components(group: pa.Table) -> pa.Table:
    """``(id, low)`` of a range's components of two or more vertices."""
    n = group.num_rows
    names = pa.concat_arrays([group["src"].combine_chunks(), group["dst"].combine_chunks()]).dictionary_encode()
    at, ids = names.indices.to_numpy(), names.dictionary
    order = np.argsort(at[:n], kind="stable")
    onward = at[n:][order].tolist()
    begin = np.searchsorted(at[:n][order], np.arange(len(ids) + 1)).tolist()
    # Tarjan's search with its own stack: ``low`` is the earliest vertex that one leads back to.
    low, number, component = [0] * len(ids), [0] * len(ids), [-1] * len(ids)
    following, path, clock, components = list(begin), [], 0, 0
    for start in range(len(ids)):
        if number[start]:
            continue
        calls = [start]
        while calls:
            v = calls[-1]
            if not number[v]:
                clock += 1
                number[v] = low[v] = clock
                path.append(v)
            deeper = False
            while following[v] < begin[v + 1]:
                w = onward[following[v]]
                if not number[w]:
                    calls.append(w)
                    deeper = True
                    break
                if component[w] < 0:
                    low[v] = min(low[v], low[w])
                following[v] += 1
            if deeper:
                continue
            calls.pop()
            if low[v] == number[v]:
                while component[v] < 0:
                    component[path.pop()] = components
                components += 1
    rows = pa.table({"id": ids, "component": component})
    least = rows.group_by("component").aggregate([("id", "min"), ("id", "count")])
    least = least.filter(pa.compute.greater(least["id_count"], 1))
    both = rows.join(least, "component", join_type="inner")
    return both.select(["id", "id_min"]).rename_columns(["id", "low"])
