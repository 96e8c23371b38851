"""Exact deduplication against immutable snapshots, screened by static binary-fuse filters.

Rows come in batches of rising ``doc_id``. Each finished batch is a snapshot: a table of
its distinct texts' digests, and for every bucket of digests a binary-fuse filter with
8-bit fingerprints, built once and never changed. A later batch first groups its own
copies, then asks the filters of each earlier snapshot about the digests that are left.
Only positives, true ones and about 1 in 256 others, join the snapshot's digests, and
those that meet are compared byte by byte.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootwise.llm.common import free_names
from rootwise.scratch import RoundTable, Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYS_PER_BUCKET = 50_000
_MIX = np.uint64(0xFF51AFD7ED558CCD)  # fixed: the 64-bit finalizer of MurmurHash3


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Keys mixed with a seed; one-to-one on 64 bits."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        for _ in range(2):
            x = (x ^ (x >> np.uint64(33))) * _MIX
        return x ^ (x >> np.uint64(33))


def _layout(n: int) -> tuple[int, int]:
    """Segment length (a power of two) and number of slots for ``n`` distinct keys."""
    if n <= 1:
        segment, slots = 4, 16
    else:
        segment = 1 << min(18, int(np.floor(np.log(n) / np.log(3.33) + 2.25)))
        slots = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))) + segment
    segments = max(1, -(-slots // segment) - 2)
    return segment, (segments + 2) * segment


def _slots(mixed: np.ndarray, segment: int, slots: int) -> np.ndarray:
    """Three slots per key, in three neighbouring segments."""
    segments = np.uint64(slots // segment - 2)
    first = ((mixed >> np.uint64(32)) * segments) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    return np.stack(
        [
            (first + np.uint64(j)) * np.uint64(segment) + ((mixed >> np.uint64(18 * j)) & mask)
            for j in range(3)
        ],
        axis=1,
    ).astype(np.int64)


def _print8(mixed: np.ndarray) -> np.ndarray:
    return ((mixed ^ (mixed >> np.uint64(29))) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, np.ndarray]:
    """``(seed, segment, fingerprints)`` of distinct 64-bit keys.

    Slots that hold one key only are taken off, wave by wave; then the waves are undone in reverse
    order, each key setting the slot it was alone in. A seed that leaves a core is replaced.
    """
    keys = np.unique(keys)
    segment, slots = _layout(len(keys))
    for seed in range(1, 1000):
        mixed = _mixed(keys, seed)
        at = _slots(mixed, segment, slots)
        count = np.bincount(at.ravel(), minlength=slots)
        held = np.zeros(slots, np.int64)  # xor of the keys in a slot names the last one left
        for j in range(3):
            np.bitwise_xor.at(held, at[:, j], np.arange(len(keys)))
        left = np.ones(len(keys), bool)
        waves = []
        while True:
            alone = np.flatnonzero(count == 1)
            owner, where = np.unique(held[alone], return_index=True)
            if not len(owner):
                break
            waves.append((owner, alone[where]))
            left[owner] = False
            for j in range(3):
                np.subtract.at(count, at[owner, j], 1)
                np.bitwise_xor.at(held, at[owner, j], owner)
        if left.any():
            continue
        prints = np.zeros(slots, np.uint8)
        for owner, slot in reversed(waves):
            want = _print8(mixed[owner])
            prints[slot] = 0
            for j in range(3):
                want = want ^ np.where(at[owner, j] == slot, 0, prints[at[owner, j]])
            prints[slot] = want
        return seed, segment, prints
    raise RuntimeError("no seed gives a filter: the keys are not spread evenly")


def in_filter(keys: np.ndarray, seed: int, segment: int, prints: np.ndarray) -> np.ndarray:
    """True for every key of the filter, and for about 1 in 256 others."""
    mixed = _mixed(keys, seed)
    at = _slots(mixed, segment, len(prints))
    return (prints[at[:, 0]] ^ prints[at[:, 1]] ^ prints[at[:, 2]]) == _print8(mixed)


def _keys(digests: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The first eight bytes of each SHA-256 as a number."""
    flat = pa.chunked_array(digests) if isinstance(digests, pa.Array) else digests
    joined = b"".join(d[:8] for d in flat.to_pylist())
    return np.frombuffer(joined, dtype="<u8")


def _filter_of(group: pa.Table) -> pa.Table:
    seed, segment, prints = build_filter(_keys(group["digest"]))
    return pa.table(
        {
            "bucket": group["bucket"].slice(0, 1),
            "seed": pa.array([seed], pa.int64()),
            "segment": pa.array([segment], pa.int64()),
            "prints": pa.array([prints.tobytes()], pa.binary()),
        }
    )


def _screened(filters: pa.Table, group: pa.Table) -> pa.Table:
    """The rows of one bucket that any earlier snapshot's filter lets through."""
    keys = _keys(group["digest"])
    hit = np.zeros(len(keys), bool)
    for one in filters.to_pylist():
        prints = np.frombuffer(one["prints"], np.uint8)
        hit |= in_filter(keys, one["seed"], one["segment"], prints)
    return group.filter(pa.array(hit))


def normalised(text: Column) -> Column:
    """Every run of white space as one space; NULL as the empty text.

    A single space stays as it is, so only other runs are sought.
    """
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def exact_groups(docs: DataFrame, n_batches: int = 3) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``.

    Texts are equal when their bytes are, after :func:`normalised`; NULL counts as empty.
    The row with the smallest ``doc_id`` of each group stays. Rows without an id stay only
    in a group that has no id at all; of repeated rows with one id, one stays. An empty
    table gives no rows; further columns are ignored.

    Texts are read once for their digests; after that only ids and digests move, apart from
    the texts of one row per batch for the groups that meet, which are checked byte by byte. Groups
    are counted with map-side sums, so a group of a third of all rows is one row per task.
    Filters are built and asked bucket by bucket; digests spread evenly whatever the texts.
    """
    rows, groups = _grouped(docs, n_batches)
    return rows.join(groups, ["digest", "bytes"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("place") == F.col("keep_place")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, n_batches: int = 3) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, with all their columns, whatever their names.

    One row of each group of equal texts stays, NULL and empty ones too: that with the smallest id, of
    rows that repeat it any one; a group of a NULL id alone keeps one row. An empty table gives no rows.
    """
    id_, kept_digest, digest = free_names(docs, "id", "kept_digest", "digest")
    rows, groups = _grouped(docs, n_batches)
    kept = groups.select(F.col("keep_id").alias(id_), F.col("digest").alias(kept_digest))
    stay = docs.withColumn(digest, F.unhex(F.sha2(normalised(F.col("text")), 256))).join(
        kept, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(digest) == F.col(kept_digest)), "left_semi"
    )
    # One id on several rows with one text: the same row, repeated.
    if rows.groupBy("doc_id", "digest").count().where("count > 1").take(1):
        stay = stay.dropDuplicates(["doc_id", digest])
    return stay.drop(digest)


def _grouped(docs: DataFrame, n_batches: int) -> tuple[DataFrame, DataFrame]:
    """``(place, doc_id, digest, bytes)`` of every row, and the groups of equal texts,
    ``(digest, bytes, keep_id, keep_place, group_size)``."""
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("text")
    ).select(
        F.monotonically_increasing_id().alias("place"),
        "doc_id",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.octet_length("text").alias("bytes"),
    )
    written = scratch.write(read)
    rows = written.df
    # Rising ranges of ids, rows without one last; where they are cut changes no result.
    shares = [k / n_batches for k in range(1, n_batches)]
    batch = F.lit(0)
    for cut in sorted(set(rows.stat.approxQuantile("doc_id", shares, 0.01) if shares else [])):
        batch = batch + F.when(F.col("doc_id").isNull() | (F.col("doc_id") > int(cut)), 1).otherwise(0)
    buckets = max(1, -(-written.rows // KEYS_PER_BUCKET))
    in_batches = scratch.write(
        rows.groupBy(batch.alias("batch"), "digest", "bytes")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")).alias("first"),
        )
        .select(
            "batch", "digest", "bytes", "n", "first.doc_id", "first.place",
            F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket"),
        )
    ).df

    snapshots: list[RoundTable] = []
    filters: list[RoundTable] = []
    met: list[RoundTable] = []
    for number in range(n_batches):
        incoming = in_batches.where(F.col("batch") == number)
        if snapshots:
            positives = (
                scratch.scan(filters)
                .groupBy("bucket")
                .cogroup(incoming.groupBy("bucket"))
                .applyInArrow(_screened, incoming.schema)
            )
            earlier = scratch.scan(snapshots).select("digest", "bytes", F.col("doc_id").alias("keep_id"))
            met.append(scratch.write(positives.join(earlier, ["digest", "bytes"])))
            incoming = incoming.join(met[-1].df, ["digest", "bytes"], "left_anti")
        snapshots.append(scratch.write(incoming))
        filters.append(
            scratch.write(
                snapshots[-1].df.groupBy("bucket").applyInArrow(
                    _filter_of, "bucket long, seed long, segment long, prints binary"
                )
            )
        )
    first = scratch.scan(snapshots).select(
        "digest", "bytes", "n", F.col("doc_id").alias("keep_id"), F.col("place").alias("keep_place")
    )
    if not met:
        return rows, first.withColumnRenamed("n", "group_size")
    again = scratch.scan(met)
    _check_bytes(scratch, docs, again)
    more = again.groupBy("digest", "bytes").agg(F.sum("n").alias("more"))
    groups = first.join(more, ["digest", "bytes"], "left").select(
        "digest", "bytes", "keep_id", "keep_place",
        (F.col("n") + F.coalesce("more", F.lit(0))).alias("group_size"),
    )
    return rows, groups


def _check_bytes(scratch: Scratch, docs: DataFrame, met: DataFrame) -> None:
    """Fail if texts that met by digest and length are not the same bytes."""
    ids = met.select(
        F.explode(F.array("doc_id", "keep_id")).alias("_id"), F.col("digest").alias("_met")
    ).distinct()
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("_doc"), "text")
        .join(ids.hint("merge"), F.col("_doc").eqNullSafe(F.col("_id")))
        .select("_met", normalised(F.col("text")).alias("text"))
        .where(F.unhex(F.sha2("text", 256)) == F.col("_met"))
    )
    differ = texts.groupBy("_met").agg((F.min("text") != F.max("text")).alias("differ")).where("differ")
    wrong = scratch.write(differ).rows
    if wrong:
        raise RuntimeError(f"{wrong} digests stand for different texts of one length")
