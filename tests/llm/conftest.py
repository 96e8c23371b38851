"""Small tables with odd rows."""

import pytest

PASSAGE = " ".join(f"alpha{i} beta{i}" for i in range(12))
CLASHING = (
    "n_words", "score", "size", "shard", "digest", "class", "hits", "row", "items", "batch", "first",
    "_id", "_kept", "_hash", "_digest", "_", "id", "kept_digest", "dropped_id", "Dropped_Hash", "none", "whole", "hash", "keep",
)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs everywhere, empty and blank texts, copies, repeated rows, long texts, clashing columns."""
    prose = "the quick brown fox jumps over the lazy dog and runs away from it all day long again"
    long = " ".join(f"word{i % 977} other{i % 31}" for i in range(30_000))
    rows = [
        (1, prose), (2, prose), (3, prose + " once"), (4, None), (5, ""), (6, " \t\n "), (7, "x"),
        (8, prose), (8, prose), (9, f"intro {PASSAGE} outro"), (10, long), (11, long + " end"), (None, "no id at all"),
        (None, None), (12, "It is  under the\nApache License, Version 2.0 and CC BY"), (13, "été ÉTÉK 12 34 !!"),
        (14, "z" * 70_000), (15, " " * 5_000 + "a b c"), (16, PASSAGE.upper()),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{name} string" for name in CLASHING
    )
    filler = ["clash"] * len(CLASHING)
    full = [
        (i, t, None if i == 1 else "en", None if i == 2 else "src", None if t is None else len(t), *filler)
        for i, t in rows
    ]
    return spark.createDataFrame(full, schema).cache()


@pytest.fixture(scope="session")
def small_benchmark(spark):
    rows = [(1, PASSAGE), (2, "lazy dog"), (10, None), (3, ""), (None, "fox"), (4, PASSAGE), (5, "absent words only")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="session")
def few_labels(spark):
    rows = [(1, 1, 0), (2, 0, 0), (3, None, 0), (3, 1, None), (None, 1, 0), (99, 0, 0), (9, 7, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
