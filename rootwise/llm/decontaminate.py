"""Benchmark decontamination with suffix arrays over shards of the documents.

Every task sorts the suffixes of its documents' words, shard by shard, and looks up every
suffix of the benchmark in them by binary search. That gives each benchmark suffix's
longest verbatim match and all places of every window. A shard is some megabytes of text,
so memory does not depend on the table, and no document leaves its task: nothing is shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.llm.common import free_names
from rootwise.llm.hashing import WordHasher, shards
from rootwise.scratch import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13  # fixed by the contamination rule
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20  # benchmark text that one broadcast may hold


@dataclass
class Tests:
    """A block of the benchmark: its words as ranks, one test suffix per word."""

    vocabulary: np.ndarray  # sorted word hashes; a word's rank is its place plus 1
    ranks: np.ndarray  # words of all items, item after item
    left: np.ndarray  # words from a suffix's start to its item's end
    window: np.ndarray  # window length at a suffix's start, 0 if none begins there
    item: np.ndarray  # number of the suffix's item
    names: list[str]  # item ids


def prepare(item_ids: list[str], texts: list[str | None], window: int = WINDOW) -> Tests:
    hashes, counts = WordHasher.letters_and_digits().words(pa.array(texts, pa.string()))
    vocabulary, place = np.unique(hashes, return_inverse=True)
    item = np.repeat(np.arange(len(counts)), counts)
    ends = np.repeat(np.cumsum(counts), counts)
    left = ends - np.arange(len(hashes))
    whole = np.repeat(counts, counts)
    fits = np.where(whole < window, left == whole, left >= window)
    length = np.where(fits, np.minimum(whole, window), 0)
    return Tests(vocabulary, place.astype(np.int64) + 1, left, length, item, item_ids)


def suffix_array(ranks: np.ndarray, bits: int, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``(places, keys, k)``: where suffixes start, sorted by their first ``depth`` words at
    least, and the first ``k`` words of each packed into a number.

    A rank of 0 ends a suffix. Suffixes that begin with it are left out.
    """
    n = len(ranks)
    k = 63 // bits
    padded = np.concatenate([ranks, np.zeros(k, np.int64)])
    packed = np.zeros(n, np.int64)
    alive = np.ones(n, bool)
    for j in range(k):
        word = padded[j : j + n]
        alive &= word > 0  # nothing counts behind the end of a suffix
        packed = (packed << bits) | np.where(alive, word, 0)
    places = np.flatnonzero(ranks > 0)
    order = np.argsort(packed[places])
    places = places[order]
    keys = packed[places]
    # A suffix's rank is the place of its group's first member; groups are split by
    # what stands ``h`` words on, and ``h`` doubles.
    m = len(places)
    if not m:
        return places, keys, k
    rank = np.zeros(n + 1, np.int64)
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    start = np.maximum.accumulate(np.where(first, np.arange(m), 0))
    rank[places] = start + 1
    tied = np.flatnonzero(~(first & np.append(first[1:], True)) & alive[places])
    h = k
    while h < depth and len(tied):
        members = places[tied]
        ahead = np.where(members + h < n, rank[np.minimum(members + h, n)], 0)
        group = rank[members]
        by = np.argsort(group * (n + 2) + ahead)
        members, ahead, group = members[by], ahead[by], group[by]
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new_part = new_group | np.concatenate([[True], ahead[1:] != ahead[:-1]])
        at = np.arange(len(members))
        base = np.maximum.accumulate(np.where(new_group, at, 0))
        part = np.maximum.accumulate(np.where(new_part, at, 0))
        slots = group - 1 + at - base
        places[slots] = members
        rank[members] = group + part - base
        alone = new_part & np.append(new_part[1:], True)
        tied = np.sort(slots[~alone & (ahead > 0)])
        h *= 2
    return places, keys, k


@dataclass
class Found:
    longest: np.ndarray  # words of each test suffix's longest match
    low: np.ndarray  # its places in the suffix array
    high: np.ndarray
    window_low: np.ndarray  # places of the window at its start
    window_high: np.ndarray


def _bound(ranks, places, low, high, depth, word, after: bool) -> np.ndarray:
    """First place in ``[low, high)`` whose word at ``depth`` is not below (or above) ``word``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) >> 1
        value = ranks[places[middle] + depth]
        below = value <= word[open_] if after else value < word[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]


def search(tests: Tests, ranks: np.ndarray, bits: int) -> tuple[np.ndarray, Found]:
    """The shard's suffix array, and what each test suffix finds in it by binary search."""
    deepest = int(tests.left.max()) if len(tests.left) else 0
    places, keys, k = suffix_array(ranks, bits, deepest)
    n = len(tests.ranks)
    got = Found(*(np.zeros(n, np.int64) for _ in range(5)))
    active = np.arange(n)
    prefix = np.zeros(n, np.int64)
    low, high = np.zeros(n, np.int64), np.full(n, len(places))
    for depth in range(1, deepest + 1):
        active = active[tests.left[active] >= depth]
        word = tests.ranks[active + depth - 1]
        if depth <= k:
            prefix[active] = (prefix[active] << bits) | word
            room = bits * (k - depth)
            below = np.searchsorted(keys, prefix[active] << room, side="left")
            above = np.searchsorted(keys, ((prefix[active] + 1) << room) - 1, side="right")
        else:
            below = _bound(ranks, places, low[active], high[active], depth - 1, word, False)
            above = _bound(ranks, places, below, high[active], depth - 1, word, True)
        some = above > below
        active = active[some]
        low[active], high[active] = below[some], above[some]
        got.longest[active] = depth
        at_window = active[tests.window[active] == depth]
        got.window_low[at_window], got.window_high[at_window] = low[at_window], high[at_window]
        if not len(active):
            break
    got.low, got.high = low, np.where(got.longest > 0, high, low)
    return places, got


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges ``[low, high)``, and the range each comes from."""
    sizes = high - low
    source = np.repeat(np.arange(len(low)), sizes)
    return np.arange(len(source)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[source], source


def _ranked(tests: Tests, texts: pa.Array, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranks of the texts' words with a 0 after each text, texts' first places, word counts.

    Words that the benchmark does not have get 0: no match goes across them.
    """
    hashes, counts = hasher.words(texts)
    place = np.searchsorted(tests.vocabulary, hashes)
    place[place == len(tests.vocabulary)] = 0
    known = tests.vocabulary[place] == hashes if len(tests.vocabulary) else np.zeros(len(hashes), bool)
    ranks = np.zeros(len(hashes) + len(counts), np.int64)
    first = np.cumsum(counts + 1) - counts - 1
    at = np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)
    ranks[at] = np.where(known, place + 1, 0)
    return ranks, first, counts


def _marker(shared, keep_text: bool):
    """A task's function: add to every row where benchmark windows cover its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests: Tests = shared.value
        bits = max(1, int(len(tests.vocabulary)).bit_length())
        hasher = WordHasher.letters_and_digits()
        for batch in shards(batches, "text", SHARD_BYTES):
            yield _marked(tests, bits, hasher, batch, keep_text)

    return run


def _marked(
    tests: Tests, bits: int, hasher: WordHasher, batch: pa.RecordBatch, keep_text: bool
) -> pa.RecordBatch:
    ranks, first, counts = _ranked(tests, batch.column("text"), hasher)
    places, got = search(tests, ranks, bits)
    rows = batch.num_rows
    owner = np.repeat(np.arange(rows), counts + 1)
    # Windows with equal words find equal places; one of them marks the words.
    with_window = np.flatnonzero(got.window_high > got.window_low)
    spans = np.stack([f[with_window] for f in (got.window_low, got.window_high, tests.window)], axis=1)
    spans, which = np.unique(spans, axis=0, return_inverse=True)
    which, length = which.ravel(), spans[:, 2]
    at, span = _spread(spans[:, 0], spans[:, 1])
    start = places[at]
    edge = np.zeros(len(ranks) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length[span], -1)
    for from_, to, doc in _earlier(batch, first):
        np.add.at(edge, from_, 1)
        np.add.at(edge, to, -1)
    covered = np.cumsum(edge)[:-1] > 0
    change = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    # Which items: each (row, span) once, then the span's items.
    pairs = np.unique(owner[start] * max(1, len(spans)) + span)
    row, span = pairs // max(1, len(spans)), pairs % max(1, len(spans))
    by_span = np.argsort(which, kind="stable")
    span_items = tests.item[with_window][by_span]
    bounds = np.searchsorted(which[by_span], np.arange(len(spans) + 1))
    index, source = _spread(bounds[span], bounds[span + 1])
    held = np.unique(row[source] * max(1, len(tests.names)) + span_items[index])
    held_row, held_item = held // max(1, len(tests.names)), held % max(1, len(tests.names))
    names = pa.array(tests.names, pa.string())
    items = _lists(held_row, names.take(pa.array(held_item, pa.int64())), rows)
    items = _joined(batch.column("items"), items)
    of_begin = owner[begins]
    columns = {name: batch.column(name) for name in batch.schema.names if keep_text or name != "text"}
    columns["n_words"] = pa.array(counts, pa.int64())
    columns["hit_from"] = _lists(of_begin, pa.array(begins - first[of_begin], pa.int64()), rows)
    columns["hit_to"] = _lists(of_begin, pa.array(ends - first[of_begin], pa.int64()), rows)
    columns["items"] = items
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _earlier(batch: pa.RecordBatch, first: np.ndarray):
    """Word ranges that earlier blocks of the benchmark have marked."""
    lists = batch.column("hit_from")
    rows = pc.list_parent_indices(lists).to_numpy()
    if len(rows):
        starts = pc.list_flatten(lists).to_numpy() + first[rows]
        ends = pc.list_flatten(batch.column("hit_to")).to_numpy() + first[rows]
        yield starts, ends, rows


def _lists(rows: np.ndarray, values: pa.Array, n: int) -> pa.ListArray:
    offsets = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _joined(left: pa.ListArray, right: pa.ListArray) -> pa.ListArray:
    rows = np.concatenate([pc.list_parent_indices(x).to_numpy() for x in (left, right)])
    values = pa.concat_arrays([pc.list_flatten(x).cast(pa.string()) for x in (left, right)])
    order = np.argsort(rows, kind="stable")
    return _lists(rows[order], values.take(pa.array(order)), len(left))


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Tests]:
    """The benchmark, prepared in blocks of about ``block_bytes`` of text, one at a time."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(
        "item_id is not null and text is not null"
    )
    items = Scratch(spark, "benchmark").write(items, bytes=F.sum(F.octet_length("text")))
    n_blocks = max(1, -(-items.counts["bytes"] // block_bytes))
    numbered = items.df.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    for block in range(n_blocks):
        rows = numbered.where(F.col("block") == block).orderBy("item_id", "text").collect()
        yield prepare([r["item_id"] for r in rows], [r["text"] for r in rows])


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, keep_text: bool = True, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with ``n_words``, the hit word ranges ``hit_from``/``hit_to``, and ``items``.

    A window is 13 consecutive words of a benchmark item, or a whole item of fewer words. All words
    of a document inside any occurrence of a window are hit; ``items`` are the ids (as strings)
    of the items whose windows occur. NULL and empty texts have no words; items without id or words
    have no windows; an empty benchmark hits nothing; repeated rows are each searched.

    The benchmark is broadcast in blocks of a fixed size. With more than one block, documents pass
    through them one after the other, their marks carried along in a written table.
    """
    spark = docs.sparkSession
    own = ["n_words", "hit_from", "hit_to", "items"]
    marked = docs.drop(*own).withColumns(
        {
            "n_words": F.lit(0).cast("long"),
            "hit_from": F.array().cast("array<long>"),
            "hit_to": F.array().cast("array<long>"),
            "items": F.array().cast("array<string>"),
        }
    )
    scratch = Scratch(spark, "decontaminate")
    blocks = benchmark_blocks(benchmark, block_bytes)
    tests = next(blocks)
    for following in blocks:
        shared = spark.sparkContext.broadcast(tests)
        marked = scratch.write(marked.mapInArrow(_marker(shared, True), marked.schema)).df
        tests = following
    schema = marked.schema if keep_text else marked.drop("text").schema
    return marked.mapInArrow(_marker(spark.sparkContext.broadcast(tests), keep_text), schema)


def contamination(
    docs: DataFrame, benchmark: DataFrame, keep_text: bool = True, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` (without their text, if so asked) with ``n_words, n_hit, n_items, items_sha256, contaminated`` for every row.

    A document is contaminated when words are hit and they are a twentieth of its words
    or more. See :func:`benchmark_hits` for what counts and for odd rows.
    """
    n_hit = F.expr("aggregate(zip_with(hit_from, hit_to, (a, b) -> b - a), 0L, (s, x) -> s + x)")
    return (
        benchmark_hits(docs, benchmark, keep_text, block_bytes)
        .withColumn("items", F.array_sort(F.array_distinct("items")))
        .withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
        .drop("hit_from", "hit_to", "items")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns, whatever their names.

    NULL and empty texts have no words and stay; repeated rows stay or go together; an empty benchmark
    takes nothing away and an empty table gives no rows.
    """
    others = [F.col(f"`{name}`") for name in docs.columns if name.lower() != "text"]
    packed = F.struct(F.lit(0).alias(free_names(docs, "none")[0]), *others).alias("row")
    clean = contamination(docs.select(packed, "text"), benchmark).where("not contaminated")
    return clean.select(
        *[F.col("text" if name.lower() == "text" else f"row.`{name}`").alias(name) for name in docs.columns]
    )


def longest_matches(docs: DataFrame, benchmark: DataFrame, least: int = WINDOW) -> DataFrame:
    """``(item_id, item_word, n_words, doc_id, doc_word)``: each benchmark suffix's longest
    verbatim match in every shard of the documents, from ``least`` words on, at all its places.

    ``item_word`` and ``doc_word`` count words from 0. A suffix that only continues the match
    of the one before it, at a place one word on, is left out.
    """
    spark = docs.sparkSession
    schema = "item_id string, item_word long, n_words long, doc_id long, doc_word long"
    parts = []
    for tests in benchmark_blocks(benchmark):
        shared = spark.sparkContext.broadcast(tests)
        parts.append(
            docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
                _locator(shared, least), schema
            )
        )
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _locator(shared, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests: Tests = shared.value
        bits = max(1, int(len(tests.vocabulary)).bit_length())
        hasher = WordHasher.letters_and_digits()
        item_start = np.searchsorted(tests.item, np.arange(len(tests.names)))
        for batch in shards(batches, "text", SHARD_BYTES):
            ranks, first, counts = _ranked(tests, batch.column("text"), hasher)
            places, got = search(tests, ranks, bits)
            owner = np.repeat(np.arange(batch.num_rows), counts + 1)
            asked = np.flatnonzero(got.longest >= least)
            at, which = _spread(got.low[asked], got.high[asked])
            suffix, place = asked[which], places[at]
            before = set(zip((suffix + 1).tolist(), (place + 1).tolist(), strict=True))
            head = np.array([pair not in before for pair in zip(suffix.tolist(), place.tolist(), strict=True)], bool)
            suffix, place = suffix[head], place[head]
            row, item = owner[place], tests.item[suffix]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tests.names, pa.string()).take(pa.array(item, pa.int64())),
                    pa.array(suffix - item_start[item], pa.int64()),
                    pa.array(got.longest[suffix], pa.int64()),
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(place - first[row], pa.int64()),
                ],
                names=["item_id", "item_word", "n_words", "doc_id", "doc_word"],
            )

    return run
