"""Take a graph apart in dependency order, one layer of finished vertices per round."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.scratch import RoundTable, Scratch

# Layers to pile up before their finished vertices are merged into one table.
MERGE_EVERY = 24


@dataclass(frozen=True)
class Peeled:
    """What a peel took off, ``(id, depth)``, and the vertices it left waiting."""

    done: DataFrame
    waiting: DataFrame | None
    rows: int


def in_degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``(id, need)`` with the number of in-edges of every vertex, 0 included."""
    uses = vertices.select("id", F.lit(0).alias("need"), F.lit(True).alias("own")).unionByName(
        edges.select(F.col("dst").alias("id"), F.lit(1).alias("need"), F.lit(False).alias("own"))
    )
    counted = uses.groupBy("id").agg(F.sum("need").alias("need"), F.max("own").alias("own"))
    return counted.where("own").drop("own")


def with_need(edges: DataFrame, needs: DataFrame) -> DataFrame:
    """``(src, dst, steps, need)``: each edge knows how many edges its target waits for.

    ``steps`` is what the edge adds to the depth, 1 unless ``edges`` says otherwise.
    """
    targets = needs.where("need > 0").select(F.col("id").alias("dst"), "need")
    steps = F.col("steps") if "steps" in edges.columns else F.lit(1)
    return edges.select("src", "dst", steps.cast("int").alias("steps")).join(targets, "dst").select("src", "dst", "steps", "need")


def peel(
    scratch: Scratch,
    edges: RoundTable,
    start: DataFrame,
    start_rows: int,
    waiting: DataFrame | None = None,
    root_id: str | None = None,
) -> Peeled:
    """Peel ``edges(src, dst, steps, need)`` from ``start(id, depth)``.

    A vertex is finished in the round in which the last of its in-edges is used. Its
    ``depth`` is the largest that a parent's depth and the steps from there make, NULL while
    no parent has one. ``waiting(id, need, got, depth)`` are vertices partly served already.
    """
    layers: list[RoundTable] = []
    total = start_rows
    live = edges
    spent = 0
    fresh, fresh_rows = start, start_rows
    newest = None
    while fresh_rows:
        table = scratch.write(
            _round(live.df, fresh, waiting, root_id),
            finished=F.count_if("finished"),
            spent=F.sum(F.when(F.col("finished"), F.col("got")).otherwise(0)),
        )
        if newest is not None:
            scratch.drop_unless(layers, newest)
        newest = table
        fresh, fresh_rows = table.df.where("finished").select("id", "depth"), table.counts["finished"]
        waiting = table.df.where("not finished").drop("finished")
        layers.append(table)
        total += fresh_rows
        spent += table.counts["spent"]
        if 2 * spent > live.rows:
            # Half of the edges lead to finished vertices: go on without them.
            used = _finished(scratch, start, layers[:-1]).select(F.col("id").alias("src"))
            rest = scratch.write_bucketed(live.df.join(used, "src", "left_anti").select("src", "dst", "steps", "need"), "src")
            if live is not edges:
                scratch.drop(live)
            live, spent = rest, 0
        if len(layers) > MERGE_EVERY:
            merged = scratch.write(scratch.scan(layers).where("finished"))
            scratch.drop(*layers[:-1])
            layers = [merged]
    return Peeled(_finished(scratch, start, layers), waiting, total)


def _finished(scratch: Scratch, start: DataFrame, layers: list[RoundTable]) -> DataFrame:
    if not layers:
        return start
    return start.unionByName(scratch.scan(layers).where("finished").select("id", "depth"))


def _round(live: DataFrame, fresh: DataFrame, waiting: DataFrame | None, root_id) -> DataFrame:
    """What the edges of the fresh vertices bring to those that wait; only these two meet."""
    served = live.join(fresh.withColumnRenamed("id", "src"), "src").select(
        F.col("dst").alias("id"),
        "need",
        F.lit(1).cast("long").alias("got"),
        (F.col("depth") + F.col("steps")).alias("depth"),
    )
    if waiting is not None:
        served = served.unionByName(waiting)
    rows = served.groupBy("id").agg(
        F.max("need").alias("need"), F.sum("got").alias("got"), F.max("depth").alias("depth")
    )
    depth = F.col("depth")
    if root_id is not None:
        depth = F.when(F.col("id") == root_id, F.coalesce(depth, F.lit(0))).otherwise(depth)
    return rows.select("id", "need", "got", depth.alias("depth"), (F.col("got") >= F.col("need")).alias("finished"))
