"""Contiguous shards of near equal byte size, by global prefix sums.

Rows are put in order by range partitions; every partition's total is one row, and the
prefix sums of these few rows tell where each partition begins. A row's place in the
whole then needs only the running sum within its own partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rootwise.scratch import Scratch

ROW_BYTES = 16  # fixed by the definition of a row's size


def balanced_shards(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row per row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 16. Rows stand in the order of ``doc_id``
    (NULL first), then ``text_crc32``, ``size`` and place in the input. A row belongs to the shard
    in which the middle of its bytes falls, so a shard's size is off its equal share by
    at most half a row at either end; a row larger than a share leaves shards empty.
    ``slot`` counts from 0 within a shard. Equal texts keep their places in the order and
    are not brought together. NULL text has no bytes; an empty table gives no rows; equal
    rows each get a slot of their own; further columns are ignored.

    Only ids, sizes and checksums are moved, never texts. The tie-break on place splits
    even an id that a third of all rows share. One row per partition goes through a
    window of one task, so that task grows with the number of partitions only.
    """
    scratch = Scratch(docs.sparkSession, "sharding")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
    ).withColumn("place", F.monotonically_increasing_id())
    order = ["doc_id", "text_crc32", "size", "place"]
    narrow = scratch.write(rows).df
    ranged = narrow.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    parts = scratch.write(ranged).df

    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    totals = (
        parts.groupBy("part")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        .select(
            "part",
            F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(everything).alias("all_bytes"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        parts.withColumn("upto", F.sum("size").over(running))
        .withColumn("nth", F.row_number().over(inside))
        .join(totals, "part")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            (F.col("rows_before") + F.col("nth") - 1).alias("rank"),
            # Twice the bytes before the middle of the row, so that all is whole numbers.
            (2 * (F.col("bytes_before") + F.col("upto")) - F.col("size")).alias("middle"),
            "all_bytes",
        )
        .withColumn("shard", F.expr(f"cast(middle * {n_shards} div (2 * all_bytes) as int)"))
        .drop("middle", "all_bytes")
    )
    placed = scratch.write(placed).df
    first = placed.groupBy("shard").agg(F.min("rank").alias("first_rank"))
    return placed.join(first, "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("first_rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
