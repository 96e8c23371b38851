"""Registered corpus queries against their SQL, and the pipeline against plain Python."""

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from check import TABLES, rows_of
from rootwise.llm.queries import LLM_ORACLES, LLM_QUERIES
from rootwise.scratch import Scratch
from tests.llm import brute
from tests.llm.test_operators import check_packing, pairs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def test_registered():
    assert set(LLM_QUERIES) <= set(entry_points.queries())
    numbers = sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES if name != "pipeline")
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_same_as_sql(spark, duck, name):
    got = LLM_QUERIES[name](spark, FOLDER).toPandas()
    want = duck.sql(LLM_ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_near_groups_of_documents(spark):
    docs = pairs(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    got = LLM_QUERIES["op3_jaccard_join"](spark, FOLDER).select("doc_id", "n_shingles", "component_id").collect()
    want = [(i, *c) for (i, _), c in zip(docs, brute.near_components(docs), strict=True)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_pipeline_stage_by_stage(spark):
    scratch = Scratch(spark, "test-pipeline")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = pairs(docs)
        docs = scratch.write(stage(spark, docs, FOLDER)).df
        if name == "packing":
            assert check_packing(docs.collect(), before, 1024) > 0.5
            break
        assert docs.columns == columns
        kept[name] = sorted(pairs(docs))
        assert set(kept[name]) <= set(before)
        if name == "exact dedup":
            firsts = {}
            for i, t in sorted(before):
                firsts.setdefault(brute.normalised(t), (i, t))
            assert kept[name] == sorted(firsts.values())
        if name == "near dedup":
            groups = brute.near_components(before, 5, 80)
            assert kept[name] == sorted(row for row, (_, c) in zip(before, groups, strict=True) if row[0] == c)
        if name == "decontamination":
            assert kept[name] == sorted(row for row in before if not brute.contamination(row[1], items)[-1])
    assert 0 < len(kept["decontamination"]) < 200


def test_pipeline_on_odd_rows(spark, odd_docs, tmp_path):
    """Every stage keeps rows and columns as they are, whatever these hold, with and without any row."""
    for name, docs in (("odd", odd_docs), ("empty", odd_docs.limit(0))):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
        labels.write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, None), (None, "x")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        scratch = Scratch(spark, "test-pipeline-odd")
        rows = spark.read.parquet(f"{folder}/documents.parquet")
        for stage, function in corpus_pipeline.STAGES[:-1]:
            before = {repr(tuple(r)) for r in rows.collect()}
            rows = scratch.write(function(spark, rows, folder)).df
            assert rows.columns == docs.columns
            after = [repr(tuple(r)) for r in rows.collect()]
            assert set(after) <= before
            assert stage in ("exact dedup", "near dedup") or set(after) == before
        pieces = corpus_pipeline.pack(spark, rows, folder).collect()
        if name == "empty":
            assert pieces == []
        else:
            check_packing(pieces, pairs(rows), 1024)
