"""What the corpus operators share: reading tables and the words of a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the texts' definition: white space, and words of letters and digits.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """``A-Z`` in lower case, as far as words of ASCII letters can tell.

    ``lower`` also changes letters beyond ASCII. Only the Kelvin sign would turn into an
    ASCII letter, so another non-ASCII letter takes its place first.
    """
    return F.lower(F.replace(text, F.lit("\u212a"), F.lit("ÿ")))


def words(text: Column) -> Column:
    """The words of a text; NULL has none."""
    return F.regexp_extract_all(F.coalesce(ascii_lower(text), F.lit("")), F.lit(WORD), F.lit(0))


def free_names(docs: DataFrame, *wanted: str) -> list[str]:
    """Names like the ``wanted`` ones that no column of ``docs`` has."""
    taken = {name.lower() for name in docs.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
