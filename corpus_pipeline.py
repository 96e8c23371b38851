"""From raw documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept, as a table written and read again. All but the
last return the columns of ``documents``; the last returns the pieces of the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rootwise.llm.common import table
from rootwise.llm.decontaminate import decontaminated
from rootwise.llm.exact_dedup import deduplicated
from rootwise.llm.jaccard_join import near_deduplicated
from rootwise.llm.packing import packed, public_vocabulary
from rootwise.llm.quality import of_quality
from rootwise.scratch import Scratch


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return of_quality(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near copies link: 0.8 or more of their shingles of 5 words."""
    return near_deduplicated(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's passages do not contaminate."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences of 1024 tokens."""
    return packed(docs, **public_vocabulary())


STAGES = [
    ("quality", keep_quality),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# The trained classifier and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir)).df
    return docs
