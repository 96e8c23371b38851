"""Tables in: a formula, vertex or edge table from any Spark source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

FORMULA_SCHEMA = "id string, name string, formula string, value int"
EDGE_SCHEMA = "src string, dst string"


def inline_table(spark: SparkSession, rows: list[tuple], schema: str, partitions: int = 0) -> DataFrame:
    """A small table given as rows, optionally spread over ``partitions``."""
    df = spark.createDataFrame(rows, schema)
    return df.repartition(partitions) if partitions else df


def read_table(
    spark: SparkSession, path: str, columns: dict[str, Column | str], fmt: str = "parquet", **options
) -> DataFrame:
    """The table at ``path`` with ``columns`` named as the operators expect them.

    ``columns`` maps a name such as ``id`` or ``formula`` to the column or expression it
    comes from; the scan reads only what these use.
    """
    df = spark.read.format(fmt).options(**options).load(path)
    return df.select(
        *[
            (source if isinstance(source, Column) else df[source]).alias(name)
            for name, source in columns.items()
        ]
    )
