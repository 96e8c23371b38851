"""Line dedup against plain Python."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from rootwise.llm.lines import keep_bitmaps, line_dedup, with_kept_lines
from tests.llm.test_operators import pairs


@pytest.fixture
def many_tasks(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield spark
    spark.conf.unset(name)


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def kept_lines(docs, min_docs, min_chars, keep_first=False):
    """Per row of ``(doc_id, text)`` whether each line stays."""
    documents = sorted({(i is not None, i or 0, t or "") for i, t in docs})
    seen, first = Counter(), {}
    for document in documents:
        keys = [key(line) for line in document[2].split("\n")]
        seen.update(set(keys))
        for at, k in enumerate(keys):
            first.setdefault(k, (document[:2], at))
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        own = (i is not None, i or 0)
        out.append([
            len(key(line)) < min_chars or seen[key(line)] < min_docs or (keep_first and first[key(line)] == (own, at))
            for at, line in enumerate(lines)
        ])
    return out


def check(docs, min_docs, min_chars=1):
    rows = pairs(docs)
    want = []
    for (i, t), stays in zip(rows, kept_lines(rows, min_docs, min_chars), strict=True):
        text = "\n".join(line for line, s in zip((t or "").split("\n"), stays, strict=True) if s)
        want.append((i, len(stays), len(stays) - sum(stays), hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in line_dedup(docs, min_docs, min_chars).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def lines_of(seed, n, hot=0):
    draw = random.Random(seed)
    shared = [f" Line {k} of many\t" for k in range(40)]
    for i in range(n):
        own = [draw.choice(shared) if draw.random() < 0.4 else f"own {i} {k}" for k in range(draw.randint(0, 9))]
        own += [draw.choice(["", "  ", "É", "é", "a", "A"])] + ["THE COMMON LINE\r"] * (i < hot)
        draw.shuffle(own)
        yield (i if draw.random() < 0.9 else None, "\n".join(own))


@pytest.mark.parametrize(("min_docs", "min_chars"), [(1, 1), (2, 2), (3, 4), (10, 1), (10, 0)])
def test_odd_rows(odd_docs, min_docs, min_chars):
    check(odd_docs, min_docs, min_chars)


@pytest.mark.parametrize("min_docs", [2, 10])
def test_hot_lines_in_many_tasks(many_tasks, min_docs):
    check(many_tasks.createDataFrame(list(lines_of(1, 600, 500)), "doc_id long, text string").repartition(5), min_docs)


def test_few_lines_at_every_edge(many_tasks):
    """So few rows that nearly every hash lies at a task's edge."""
    docs = [(i, "one line\ntwo lines") for i in range(11)] + [(20 + i, "nine lines") for i in range(9)]
    check(many_tasks.createDataFrame(docs, "doc_id long, text string"), 10)


def test_first_places_stay(many_tasks):
    rows = [(i, t) for i, t in lines_of(2, 300, 250) if i is not None]
    docs = many_tasks.createDataFrame(rows, "doc_id long, text string")
    marks = {r["doc_id"]: r for r in keep_bitmaps(docs, 1, 1, keep_first=True).collect()}
    for (i, t), stays in zip(rows, kept_lines(rows, 1, 1, keep_first=True), strict=True):
        if all(stays):
            assert i not in marks
            continue
        bits = np.unpackbits(np.frombuffer(zlib.decompress(marks[i]["keep"]), np.uint8), count=len(stays))
        assert bits.astype(bool).tolist() == stays
        assert marks[i]["n_dropped"] == len(stays) - sum(stays)


def test_nothing(odd_docs):
    assert line_dedup(odd_docs.limit(0)).count() == 0
    assert keep_bitmaps(odd_docs.limit(0)).count() == 0


def test_columns_stay(odd_docs):
    docs = odd_docs.withColumnRenamed("score", "keep")
    kept = with_kept_lines(docs, keep_bitmaps(docs, 2))
    assert kept.columns == [c for c in docs.columns] + ["kept_text", "n_lines", "n_dropped"]
    assert sorted(map(repr, pairs(kept))) == sorted(map(repr, pairs(docs)))
