"""Round tables: where iterative operators keep what one round hands to the next.

Each round is written as a parquet table in the folder the cluster shares, and the
next round reads it back. That cuts lineage, survives the loss of any executor, and
tells the planner the true size of the data, so a join side is broadcast only when its
files are below ``spark.sql.autoBroadcastJoinThreshold``. Row counts come out of the
write itself (``observe``), so the driver sees numbers and never rows.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """Folder for round tables, one that every executor can reach.

    The session's ``spark.checkpoint.dir``; where that is unset, a subfolder of
    ``spark.sql.warehouse.dir``, which the executors share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/rounds"


@dataclass
class RoundTable:
    """A written table, its row count and any further counts taken while writing."""

    spark: SparkSession
    path: str
    schema: T.StructType
    rows: int
    counts: dict[str, int] = field(default_factory=dict)
    name: str | None = None  # in the session's catalog, of a bucketed table

    @cached_property
    def df(self) -> DataFrame:
        if self.name:
            return self.spark.table(self.name)
        return self.spark.read.schema(self.schema).parquet(self.path)


class Scratch:
    """One operator run's folder of round tables."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{_session_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self._written = 0

    def write(
        self, df: DataFrame, partition_by: tuple[str, ...] = (), **counts: Column
    ) -> RoundTable:
        """Write ``df`` once; ``counts`` are extra aggregates observed on the way."""
        path, seen = self._next_path(), Observation()
        writer = _watched(df, seen, counts).write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return self._table(df, path, seen, counts)

    def write_bucketed(self, df: DataFrame, key: str, spread: bool = True, **counts: Column) -> RoundTable:
        """Write ``df`` once, bucketed and sorted by ``key``, one file a bucket.

        A join on ``key`` then reads it as it lies: only the other side is shuffled, however often such
        joins are made. There are ``spark.sql.shuffle.partitions`` buckets. Rows that a grouping or join by
        ``key`` has just dealt out need no other shuffle: ``spread`` is then false.
        """
        path, seen = self._next_path(), Observation()
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"{_table_prefix(self.spark)}{uuid.uuid4().hex}"
        watched = _watched(df, seen, counts)
        dealt = watched.repartition(buckets, key) if spread else watched
        dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
        table = self._table(df, path, seen, counts)
        table.name = name
        return table

    def _next_path(self) -> str:
        self._written += 1
        return f"{self.path}/{self._written - 1:05d}"

    def _table(self, df: DataFrame, path: str, seen: Observation, counts: dict[str, Column]) -> RoundTable:
        got = seen.get
        extra = {name: got.get(name) or 0 for name in counts}
        return RoundTable(self.spark, path, df.schema, got.get("rows", 0), extra)

    def scan(self, tables: list[RoundTable]) -> DataFrame:
        """All rows of several round tables of one schema, as a single file scan."""
        return self.spark.read.schema(tables[0].schema).parquet(*[t.path for t in tables])

    def drop(self, *tables: RoundTable) -> None:
        """Delete tables that nothing reads any more."""
        for table in tables:
            if table.name:
                self.spark.sql(f"DROP TABLE IF EXISTS {table.name}")
            _delete(self.spark, table.path)

    def drop_unless(self, kept: list[RoundTable], table: RoundTable) -> None:
        """Delete ``table`` if it has been merged into another: it is not among ``kept``."""
        if all(table is not other for other in kept):
            self.drop(table)


def clear_round_tables(spark: SparkSession) -> None:
    """Delete this application's round tables.

    Call it when no result of this package is still to be read: results are DataFrames
    over round tables. Other applications' tables in the same folder stay.
    """
    for table in spark.catalog.listTables():
        if table.name.startswith(_table_prefix(spark)):
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    _delete(spark, _session_dir(spark))


def _watched(df: DataFrame, seen: Observation, counts: dict[str, Column]) -> DataFrame:
    named = [agg.alias(name) for name, agg in counts.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *named)


def _table_prefix(spark: SparkSession) -> str:
    return "rootwise_" + re.sub(r"\W", "_", spark.sparkContext.applicationId).lower() + "_"


def _session_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/rootwise/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
