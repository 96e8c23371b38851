"""The pipeline's near-copy stage against all pairs, by shingles of 5 words and a similarity of 0.8."""

import numpy as np
import pytest

import corpus_pipeline
from rootwise.llm.jaccard_join import _near, _sketch, may_link, near_deduplicated, near_groups, sketch_bits
from tests.llm import brute


def changed(words, places):
    return " ".join("other" if i in places else word for i, word in enumerate(words))


def test_the_stage_drops_near_copies_from_0_8_up(spark):
    words = [f"w{i}" for i in range(100)]
    docs = [(1, changed(words, ())), (2, changed(words, (30, 70))), (3, changed(words, (10, 30, 70)))]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(docs, "doc_id long, text string"), "")
    assert sorted(tuple(r) for r in got.collect()) == [docs[0]]  # 2 and 3 are linked, and 1 and 2


def test_the_stage_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    want = [row for row, (_, c) in zip(rows, brute.near_components(rows, 5, 80), strict=True) if row[0] == c]
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == want


@pytest.mark.parametrize(("n", "percent"), [(5, 80), (4, 93), (2, 60)])
def test_near_copies_around_the_threshold(spark, monkeypatch, n, percent):
    """Texts of 1 to 300 words with a few words changed, and a line that many of them share."""
    monkeypatch.setattr("rootwise.llm.jaccard_join.HOT_IN_BATCH", 8)
    random = np.random.default_rng(n)
    docs = []
    for size in [*range(1, 30), *random.integers(30, 300, 30)]:
        base = [f"w{k}" for k in random.integers(0, 5000, size)]
        for changes in (0, 1, 2, size // 60, size // 40, size // 25, size // 20):
            own = changed(base, set(random.integers(0, size, changes).tolist()))
            docs.append((len(docs), own + " a line that very many of the texts share" * (len(docs) % 3)))
    got = near_groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), n, percent)
    want = [(i, *c) for (i, _), c in zip(docs, brute.near_components(docs, n, percent), strict=True)]
    assert sorted(map(tuple, got.collect())) == want


def test_one_id_on_two_texts(spark):
    words = [f"w{i}" for i in range(100)]
    docs = [(1, changed(words, ())), (2, changed(words, (50,))), (2, "a clean text that nothing else is like"), (2, None)]
    got = near_deduplicated(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [docs[0], *docs[2:]]))


def test_long_sets_and_clusters_over_several_tasks(spark, monkeypatch):
    """Sketches of several widths, folded to meet; clusters whose sets no task takes together."""
    monkeypatch.setattr("rootwise.llm.jaccard_join.CHECK_BYTES", 100_000)
    random = np.random.default_rng(1)
    docs = []
    for size in (600, 1150, 1300, 2400, 5000):
        base = [f"w{k}" for k in random.integers(0, 10**6, size)]
        for n in range(6):
            own = changed(base[: size - n * size // 40], set(random.integers(0, size, n * size // 100).tolist()))
            docs.append((len(docs), own))
    for n, percent in ((5, 80), (3, 90)):
        got = near_groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), n, percent)
        want = [(i, *c) for (i, _), c in zip(docs, brute.near_components(docs, n, percent), strict=True)]
        assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("percent", [80, 90])
@pytest.mark.parametrize("size", [100, 4000, 20_000])
def test_sketches_rule_out_unlike_sets_at_every_size(size, percent):
    """Sets of no similarity, and of half, never pass; linked ones always do."""
    random = np.random.default_rng(size)
    for common in (0, 2 * size // 3):
        a, b = random.integers(0, 1 << 63, (2, size), np.uint64)
        b[:common] = a[:common]
        assert not _near([_sketch(np.unique(x), percent) for x in (a, b)], np.array([size, size]), percent).any()
    less = size * percent // 100 + 1
    for other in (a[:less], np.concatenate([a[: size - size * (100 - percent) // 250], b[: size * (100 - percent) // 250]])):
        sizes = np.array([size, len(other)])
        distance = len(np.setxor1d(a, other))
        assert may_link(sizes[0], sizes[1], distance, percent)
        assert _near([_sketch(np.unique(x), percent) for x in (a, other)], sizes, percent).sum() == 2
    assert sketch_bits(size, percent) >= 8 * (100 - percent) * 2 * size // (100 + percent)


def test_stage_of_nothing(spark, odd_docs):
    assert near_deduplicated(odd_docs.limit(0), 5, 80).collect() == []
    assert near_groups(odd_docs.limit(0), 5, 80).count() == 0


def test_odd_rows_at_0_8(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_groups(odd_docs, 5, 80).collect()]
    want = [(i, *c) for (i, _), c in zip(rows, brute.near_components(rows, 5, 80), strict=True)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
