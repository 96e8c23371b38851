"""Phrase collocations against plain Python."""

import random
import re
import string
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rootwise.llm import bitmaps, phrases
from rootwise.llm.phrases import collocations

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "doc_id long, text string, lang string"


def brute(docs, low=2, high=3, min_count=10, inside=50, top=2000):
    """The rows for ``(text, lang)`` documents."""
    counts, words = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            own = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(own)
            counts[lang].update(tuple(own[i : i + m]) for m in range(1, high + 1) for i in range(len(own) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: n for p, n in f.items() if len(p) >= low and n >= min_count}
        longer = Counter()
        for p, n in candidates.items():
            for m in range(1, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i : i + m]] = max(longer[p[i : i + m]], n)
        rows = []
        for p, a in candidates.items():
            if longer[p] and 100 * longer[p] >= inside * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return out


def check(docs, **options):
    rows = [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]
    got = [tuple(r) for r in collocations(docs, *options.get("args", ())).collect()]
    want = brute(rows, *options.get("args", ()))
    assert sorted(got) == sorted(want)
    return want


def texts(seed, n):
    draw = random.Random(seed)
    words = [f"w{int(draw.paretovariate(0.7))}" for _ in range(4000)]
    for i in range(n):
        own = []
        for _ in range(draw.randint(0, 40)):
            at = draw.randrange(len(words) - 4)
            own.append(" ".join(words[at : at + draw.randint(1, 4)]).upper() if draw.random() < 0.2 else words[at])
            own.append(draw.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "?!", " "]))
        yield (i, "".join(own) + "of the very same phrase " * draw.randint(0, 2), draw.choice(["en", "en", "de", None, "EN"]))


def test_odd_rows(spark, odd_docs):
    check(odd_docs)
    assert check(odd_docs, args=(2, 4, 1, 50, 5))


@pytest.mark.parametrize("args", [(), (2, 3, 3, 50, 20), (2, 5, 4, 80, 2000), (3, 4, 5, 30, 7), (2, 2, 2, 50, 50)])
def test_random_texts(spark, args):
    docs = spark.createDataFrame(list(texts(3, 400)), SCHEMA).repartition(3)
    assert len(check(docs, args=args)) > 10


def test_long_prefixes_and_many_groups(spark, monkeypatch):
    """Groups so small that prefixes of one and of two words are lengthened; bitmaps so small that they are full."""
    monkeypatch.setattr(phrases, "GROUP_SUFFIXES", 300)
    monkeypatch.setattr(phrases, "LONG_PREFIX", 60)
    monkeypatch.setattr(phrases, "HELD_SUFFIXES", 500)
    monkeypatch.setattr(phrases, "HELD_TYPES", 50)
    monkeypatch.setattr(phrases, "SHARD_BYTES", 1000)
    monkeypatch.setattr(phrases, "PREFIX_BITS", 10)  # and numbers that many suffixes share
    docs = spark.createDataFrame(list(texts(4, 400)), SCHEMA).repartition(3)
    check(docs, args=(2, 4, 3, 50, 2000))
    monkeypatch.setattr(bitmaps, "FILTER_BITS", 64)
    monkeypatch.setattr(bitmaps, "SEGMENT_BITS", 16)
    check(docs, args=(2, 4, 3, 50, 2000))


def test_words_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 7)
    check(spark.createDataFrame(list(texts(5, 60)), SCHEMA).repartition(1), args=(2, 3, 2, 50, 2000))


def test_products_beyond_64_bits(spark):
    big = 10**14
    nodes = [([1], 3 * big), ([2], 7 * big), ([3], big + 1), ([1, 2], big - 1), ([2, 3], big // 3), ([1, 2, 3], big // 7)]
    rows = phrases._scored(spark.createDataFrame(nodes, "words array<long>, n long"), 2).collect()
    f = {tuple(w): n for w, n in nodes}
    for r in rows:
        p = tuple(r["words"])
        want = min((10**6 * f[p] ** 2 // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
        assert (r["a"], r["score"], r["l"], r["r"]) == (f[p], want[0], f[p[: want[1]]], f[p[want[1] :]])
    assert len(rows) == 3


def test_nothing(spark, odd_docs):
    assert collocations(odd_docs.limit(0)).count() == 0
    assert collocations(spark.createDataFrame([(1, None, None), (2, "", "en"), (3, ".,;", "en")], SCHEMA)).count() == 0
    with pytest.raises(ValueError, match="two words"):
        collocations(odd_docs, min_words=1)


def test_a_task_holds_few_suffixes(spark):
    """The suffixes of 3 million words go out in parts: the memory does not grow with a task's texts."""

    class Filters:
        value = [np.full(bitmaps.FILTER_BITS // 8, 255, np.uint8)]

    words = " ".join(f"w{i}" for i in range(100_000))
    batch = pa.RecordBatch.from_arrays([pa.array([words]), pa.array([1])], names=["text", "lang_hash"])
    run = phrases._to_groups(Filters, 3, 4)
    tracemalloc.start()
    found = sum(len(block[-1].as_py()) for out in run(iter([batch] * 30)) for block in out.column("block"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found > 0
    assert peak < 250 << 20
