"""Pointers followed by doubling: where ways end, and which run in rings.

Every vertex has one pointer, ``(id, to)``. A round puts two ways of one length together, so a way of n steps
takes as many rounds as n has binary digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.scratch import RoundTable, Scratch


def way_ends(scratch: Scratch, pointers: DataFrame) -> tuple[DataFrame, RoundTable]:
    """``(id, end, steps)``: the first vertex on the way that has no pointer, and how far; and the pointers of ways without one.

    These ways lead into rings.
    """
    ids = pointers.select(F.col("id").alias("to"), F.lit(True).alias("goes_on"))
    tagged = pointers.join(ids, "to", "left").select(
        "id", "to", F.lit(1).cast("long").alias("steps"), F.col("goes_on").isNull().alias("ended")
    )
    last = scratch.write(tagged, ended=F.count_if("ended"))
    tables = [last]
    while last.counts["ended"] and last.counts["ended"] < last.rows:
        ended = scratch.scan(tables).where("ended")
        here = last.df.where("not ended")
        onward = ended.unionByName(here).toDF("to", "next", "more", "ends")
        steps = (F.col("steps") + F.col("more")).alias("steps")
        joined = here.join(onward, "to").select("id", F.col("next").alias("to"), steps, F.col("ends").alias("ended"))
        last = scratch.write(joined, ended=F.count_if("ended"))
        tables.append(last)
    return scratch.scan(tables).where("ended").select("id", F.col("to").alias("end"), "steps"), last


def rings(scratch: Scratch, pointers: DataFrame, rows: int) -> DataFrame:
    """``(id, low, n)``: the vertices on rings, with the smallest id of their ring and its length.

    ``pointers`` has ``rows`` rows, and all of them lead to ids with a pointer. Where ``2**k`` steps from
    all vertices lead is a smaller set every round, until twice as many steps lead to as many: then these
    are the vertices on rings. Each takes the smallest id on its way, over ways of doubling length, until a
    round changes none: then the ways go all round.
    """
    jumps = scratch.write(pointers)
    before = rows
    while True:
        image = scratch.write(jumps.df.select(F.col("to").alias("id")).distinct())
        if image.rows == before:
            break
        before, onward = image.rows, jumps.df.toDF("to", "next")
        doubled = scratch.write(jumps.df.join(onward, "to").select("id", F.col("next").alias("to")))
        scratch.drop(jumps, image)
        jumps = doubled
    scratch.drop(jumps)
    ways = scratch.write(
        pointers.join(image.df, "id").select("id", "to", F.col("id").alias("low"), F.lit(True).alias("new")),
        changed=F.count("id"),
    )
    while ways.counts["changed"]:
        onward = ways.df.select(F.col("id").alias("to"), F.col("to").alias("next"), F.col("low").alias("lower"))
        low = F.least("low", "lower")
        longer = ways.df.join(onward, "to").select(
            "id", F.col("next").alias("to"), low.alias("low"), (low < F.col("low")).alias("new")
        )
        doubled = scratch.write(longer, changed=F.count_if("new"))
        scratch.drop(ways)
        ways = doubled
    sizes = ways.df.groupBy("low").agg(F.count(F.lit(1)).alias("n"))
    return ways.df.join(sizes, "low").select("id", "low", "n")
