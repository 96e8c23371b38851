"""N-gram Jaccard join by PartEnum signatures, and the groups of near copies it links.

Sets of near equal size fall into a band; two linked sets lie in one band or in neighbouring ones.
For a band, linked sets differ in at most ``k`` elements. The domain of elements is
cut into first-level partitions so many that one of them holds at most one
difference; that one is cut into cells, and every subset that leaves out one cell is a
signature. One of these subsets leaves out the difference, so linked sets share a signature.

Below a similarity of 0.9 the cells would hold so few elements that unlike sets share them. There a
set's signatures are its first elements in an order of all elements, common ones last: so
many that the rest alone is too small for a link. Linked sets share one of these as well.

Sets that share one are compared by parity sketches first: a sketch's distance is never
more than the sets', so nothing linked is lost. A sketch has bits in proportion to the distance that its set's
links may have, so that it tells unlike sets apart at every size; a longer sketch folds to a shorter
one. What is left is checked exactly, each set being sent once for all pairs of its cluster.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.llm.bitmaps import bitmap_of, held_by, joint_key
from rootwise.llm.common import free_names
from rootwise.llm.components import components
from rootwise.llm.hashing import WordHasher, mix, shards
from rootwise.scratch import RoundTable, Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 3
PERCENT = 90
PARTITIONED = 90  # similarity in percent from which on signatures are PartEnum's
COMMON_IN_BATCH = 4  # sets of a batch that share an element from which on it is counted
COMMON = 200_000  # common elements that every task holds
SHARD_BYTES = 4 << 20
SKETCH_BITS = 2048  # the least
BITS_PER_DIFFERENCE = 8  # of a sketch, for each element that linked sets of its size may differ in
HOT_IN_BATCH = 1  # sets of one signature in a batch beyond which it needs no detection
GROUP_BYTES = 24 << 20  # signatures that one detecting task sorts at once
BLOCK = 1024  # sets compared with as many at once
SKETCH_BYTES = 8 << 20  # sketches that one comparing task holds, about
CHECK_BYTES = 16 << 20  # elements that one checking task holds, about
SETS = "class long, n_shingles long, sketch binary"


def bands(largest: int, percent: int = PERCENT) -> np.ndarray:
    """Smallest size of each band, until past ``largest``; a band's sizes are within 100 to ``percent``."""
    low = [1]
    while low[-1] <= largest:
        low.append(low[-1] * 100 // percent + 1)
    return np.array([*low, low[-1] * 100 // percent + 1])


def least_size(percent: int) -> int:
    """The size from which on a set may link with one that is not equal."""
    return -(-percent // (100 - percent))


def may_link(a: np.ndarray, b: np.ndarray, distance: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether sets of ``a`` and ``b`` elements that differ in ``distance`` reach the similarity."""
    return (100 + percent) * distance <= (100 - percent) * (a + b)


# -- sets ------------------------------------------------------------------------------


def _shingles(hashes: np.ndarray, shingle: int) -> np.ndarray:
    """The distinct shingles of one text's words, sorted; all its words as one if there are fewer."""
    if not len(hashes):
        return hashes
    n = min(shingle, len(hashes))
    total = np.full(len(hashes) - n + 1, n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            total = mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[j : len(hashes) - n + 1 + j])
    return np.unique(total)


def _class(elements: np.ndarray) -> int:
    """A number for the set. Of a billion different sets two share one with a chance of 1 in 37."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(elements).sum() + np.uint64(len(elements))]))[0].view(np.int64))


def sketch_bits(size: int, percent: int) -> int:
    """A power of two, in proportion to the most that linked sets of ``size`` elements differ in."""
    wanted = BITS_PER_DIFFERENCE * (100 - percent) * 2 * size // (100 + percent)
    return max(SKETCH_BITS, 1 << max(0, wanted - 1).bit_length())


def _sketch(elements: np.ndarray, percent: int) -> bytes:
    """Bit i: whether an odd number of elements fall on i."""
    bits = sketch_bits(len(elements), percent)
    count = np.bincount(((elements >> np.uint64(7)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8)).tobytes()


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    hasher = WordHasher.unbroken()
    for batch in shards(batches, "text", SHARD_BYTES):
        hashes, counts = hasher.words(batch.column("text"))
        cuts = np.concatenate([[0], np.cumsum(counts)])
        yield batch, [_shingles(hashes[cuts[i] : cuts[i + 1]], shingle) for i in range(len(counts))]


def _describe(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, shingle):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array([_class(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_sketch(s, percent) if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "text_hash", "class", "n_shingles", "sketch"],
            )

    return run


# -- signatures ------------------------------------------------------------------------


def signatures(elements: np.ndarray, low: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The signatures of one sorted set, for its band with the next and with the one before.

    Cells are ranges of the hashed elements, so a cell's elements stand together.
    """
    size = len(elements)
    if size < least_size(percent):  # smaller sets are linked with equal ones only
        return np.empty(0, np.uint64)
    own = int(np.searchsorted(low, size, side="right")) - 1
    found = []
    with np.errstate(over="ignore"):
        upto = np.concatenate([[np.uint64(0)], np.cumsum(mix(elements ^ np.uint64(0xA5A5A5A5A5A5A5A5)))])
        for band in (own - 1, own):
            most = (100 - percent) * (int(low[band + 1]) - 1 + int(low[band + 2]) - 1) // (100 + percent)
            first, cells = most // 2 + 1, 5 if most <= 8 else 3
            width = (1 << 64) // (first * cells) + 1
            edges = np.arange(1, first * cells, dtype=np.uint64) * np.uint64(width)
            at = np.concatenate([[0], np.searchsorted(elements, edges), [size]])
            cell = (upto[at[1:]] - upto[at[:-1]]).reshape(first, cells)
            left = cell.sum(axis=1, keepdims=True, dtype=np.uint64) - cell  # all cells but one
            place = np.arange(first * cells, dtype=np.uint64).reshape(first, cells)
            found.append(mix(mix(left) + place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band + 1)).ravel())
    return np.concatenate(found)


def prefix(elements: np.ndarray, common: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """The elements of one sorted set that come first: those not common, then the least common.

    ``common`` is sorted, and ``rank`` tells how common each is. Any order of all elements finds the same links.
    """
    size = len(elements)
    if size < least_size(percent):
        return np.empty(0, np.uint64)
    if len(common):
        at = np.minimum(np.searchsorted(common, elements), len(common) - 1)
        elements = elements[np.argsort(np.where(common[at] == elements, rank[at], -1), kind="stable")]
    return elements[: size - -(-percent * size // 100) + 1]


def _common_counter(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, shingle):
            elements, n = np.unique(np.concatenate(sets or [np.empty(0, np.uint64)]), return_counts=True)
            many = n >= COMMON_IN_BATCH
            columns = [pa.array(elements[many].view(np.int64)), pa.array(n[many])]
            yield pa.RecordBatch.from_arrays(columns, names=["element", "n"])

    return run


def _common(scratch: Scratch, docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The most common elements, sorted, and the rank of each, from 0 for the least common."""
    counted = docs.select("text").mapInArrow(_common_counter(shingle), "element long, n long")
    counted = scratch.write(counted.groupBy("element").agg(F.sum("n").alias("n"))).df
    # The least count at which no more than COMMON elements are left, from a histogram.
    step = F.floor(F.log2("n") * 16)
    histogram = counted.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("elements"), F.min("n").alias("least"))
    room, least = COMMON, None
    for row in sorted(histogram.collect(), reverse=True):
        room -= row["elements"]
        if room < 0:
            break
        least = row["least"]
    most = counted.where(F.col("n") >= least if least is not None else F.lit(False)).toArrow()
    elements = most["element"].to_numpy().view(np.uint64)
    order = np.argsort(elements)
    rank = np.empty(len(elements), np.int64)
    rank[np.lexsort((elements, most["n"].to_numpy()))] = np.arange(len(elements))
    return elements[order], rank[order]


def _signer(signed, shingle: int, least: int, parts: int):
    """A task's function: blocks of ``(signature, class)`` for the tasks that look for shared ones.

    A signature that many sets of a batch share is known to be shared. Its sets go, marked
    and to any task; one alone stands for them where other batches' sets are looked through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for _, sets in _sets(batches, shingle):
            for elements in sets:
                name = _class(elements) if len(elements) >= least else None
                if name is None or name in seen:
                    continue
                seen.add(name)
                own = signed(elements)
                held.append((own, np.full(len(own), name, np.int64)))
                size += len(own)
            if len(seen) > 500_000:
                seen.clear()
            if size > 1_000_000:
                yield _blocks(held, parts)
                held, size = [], 0
        if held:
            yield _blocks(held, parts)

    return run


def _blocks(held: list[tuple[np.ndarray, np.ndarray]], parts: int) -> pa.RecordBatch:
    signature = np.concatenate([s for s, _ in held])
    name = np.concatenate([c for _, c in held])
    order = np.argsort(signature)
    signature, name = signature[order], name[order]
    first = np.concatenate([[True], signature[1:] != signature[:-1]])
    run = np.cumsum(first) - 1
    hot = np.bincount(run)[run] > HOT_IN_BATCH
    rows = []
    plain = ~hot | first
    to = (signature % np.uint64(parts)).astype(np.int64)
    for part in np.unique(to[plain]):
        mine = plain & (to == part)
        rows.append((int(part), False, signature[mine].tobytes(), name[mine].tobytes()))
    if hot.any():
        anywhere = int(signature[0] % np.uint64(parts))
        rows.append((anywhere, True, signature[hot].tobytes(), name[hot].tobytes()))
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "hot", "signatures", "classes"]
    )


def _shared(group: pa.Table) -> pa.Table:
    """The members of every signature that more than one set has."""
    hot = group["hot"].to_pylist()
    signatures_, classes = (
        [np.frombuffer(b, kind) for b in group[name].to_pylist()]
        for name, kind in (("signatures", np.uint64), ("classes", np.int64))
    )
    # A hot signature's stand-in is the first of its sets, so it meets itself there.
    signature = np.concatenate([s for s, h in zip(signatures_, hot, strict=True) if not h] or [np.empty(0, np.uint64)])
    name = np.concatenate([c for c, h in zip(classes, hot, strict=True) if not h] or [np.empty(0, np.int64)])
    order = np.lexsort((name, signature))
    signature, name = signature[order], name[order]
    known = [s for s, h in zip(signatures_, hot, strict=True) if h]
    new = np.concatenate([[True], (signature[1:] != signature[:-1]) | (name[1:] != name[:-1])])[: len(name)]
    signature, name = signature[new], name[new]
    run = np.cumsum(np.concatenate([[True], signature[1:] != signature[:-1]])[: len(name)]) - 1
    many = np.bincount(run)[run] > 1 if len(run) else np.zeros(0, bool)
    signature = np.concatenate([signature[many], *known])
    name = np.concatenate([name[many], *(c for c, h in zip(classes, hot, strict=True) if h)])
    return pa.table({"signature": pa.array(signature.view(np.int64)), "class": pa.array(name)})


# -- candidates ------------------------------------------------------------------------


def _candidates(every: bool, percent: int):
    """Pairs of a group's buckets whose sketches allow a link.

    Either a spanning forest of them in each bucket, or every pair of different components.
    """

    def run(group: pa.Table) -> pa.Table:
        signature = group["signature"].to_numpy()
        order = np.lexsort((group["class"].to_numpy(), group["right"].to_numpy(), group["left"].to_numpy(), signature))
        group = group.take(pa.array(order))
        unit = np.stack([group[name].to_numpy() for name in ("signature", "left", "right")])
        name, size, component, side = (
            group[c].to_numpy() for c in ("class", "n_shingles", "component", "side")
        )
        sketches = group["sketch"].to_pylist()
        starts = np.flatnonzero(np.concatenate([[True], (unit[:, 1:] != unit[:, :-1]).any(axis=0)]))
        found = set()
        for start, end in zip(starts, np.append(starts[1:], len(name)), strict=True):
            own = slice(start, end)
            whole = unit[1, start] == unit[2, start]
            near = _near(sketches[own], size[own], percent)
            if not whole:
                near &= side[own][:, None] != side[own][None, :]
            near &= component[own][:, None] != component[own][None, :]
            edges = np.argwhere(np.triu(near, 1)) if every else _forest(near)
            for i, j in edges:
                a, b = int(name[start + i]), int(name[start + j])
                found.add((min(a, b), max(a, b)))
        pairs = sorted(found)
        return pa.table(
            {"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())}
        )

    return run


def _near(sketches: list[bytes], size: np.ndarray, percent: int) -> np.ndarray:
    near = np.zeros((len(size), len(size)), bool)
    width = np.array([len(sketch) for sketch in sketches])
    by_width = {}
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        by_width[w] = rows, np.frombuffer(b"".join(sketches[i] for i in rows), np.uint64).reshape(len(rows), -1)
    for w, (rows, bits) in by_width.items():
        _mark(near, size, percent, rows, bits, rows, bits)
        # The next width, folded; sets still wider are too large for a link.
        if 2 * w in by_width:
            wider, halves = by_width[2 * w]
            _mark(near, size, percent, rows, bits, wider, halves[:, : w // 8] ^ halves[:, w // 8 :])
    np.fill_diagonal(near, False)
    return near


def _mark(near, size, percent, left, left_bits, right, right_bits) -> None:
    for i, bits in zip(left.tolist(), left_bits, strict=True):
        fit = np.flatnonzero(may_link(size[right], size[i], np.abs(size[right] - size[i]), percent))
        distance = np.bitwise_count(right_bits[fit] ^ bits).sum(axis=1, dtype=np.int64)
        found = right[fit[may_link(size[right[fit]], size[i], distance, percent)]]
        near[i, found] = near[found, i] = True


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    new = np.ones(len(near), bool)
    edges = []
    for root in range(len(near)):
        if not new[root]:
            continue
        new[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            reached = np.flatnonzero(near[at] & new)
            new[reached] = False
            edges += [(at, int(to)) for to in reached]
            queue += reached.tolist()
    return edges


def _compared(
    members: DataFrame, sets: DataFrame, labels: DataFrame | None, groups: int, percent: int
) -> DataFrame:
    """Distinct candidate pairs ``(a, b)``; with ``labels``, all those of different components."""
    known = members.join(sets, "class")
    if labels is not None:
        known = known.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
        mixed = known.groupBy("signature").agg((F.min("component") != F.max("component")).alias("mixed"))
        known = known.join(mixed.where("mixed"), "signature", "left_semi")
    else:
        known = known.withColumn("component", F.col("class"))
    # A large bucket in blocks: each set meets its own block and every other.
    blocks = F.ceil(F.col("members") / BLOCK).cast("long")
    own = F.pmod(F.xxhash64("class"), F.col("blocks"))
    units = (
        known.withColumn("blocks", blocks)
        .withColumn("side", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("left", F.least("side", "other"))
        .withColumn("right", F.greatest("side", "other"))
    )
    key = F.pmod(F.xxhash64("signature", "left", "right"), F.lit(groups))
    pairs = (
        units.select("signature", "left", "right", "side", "class", "component", "n_shingles", "sketch", key.alias("g"))
        .groupBy("g")
        .applyInArrow(_candidates(labels is not None, percent), "a long, b long")
    )
    return pairs.distinct()


# -- exact check -----------------------------------------------------------------------


def _elements(shingle: int, wanted):
    """A task's function: the sets of the rows that the bitmap holds, and perhaps of a few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def some() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = [pc.fill_null(batch.column(name), 0).to_numpy().view(np.uint64) for name in ("doc_id", "text_hash")]
                yield batch.filter(pa.array(held_by(wanted.value, joint_key(ids))))

        for _, sets in _sets(some(), shingle):
            yield pa.RecordBatch.from_arrays(
                [pa.array([_class(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["class", "elements"],
            )

    return run


def _linked(percent: int):
    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        elements = dict(zip(sets["class"].to_pylist(), sets["elements"].to_pylist(), strict=True))
        linked = []
        for one, other in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist(), strict=True):
            a, b = (np.frombuffer(elements[name], np.uint64) for name in (one, other))
            both = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(100 * both >= percent * (len(a) + len(b) - both))
        return pairs.select(["a", "b"]).append_column("linked", pa.array(linked, pa.bool_()))

    return run


def _checked(
    scratch: Scratch, docs: DataFrame, sets: DataFrame, pairs: RoundTable, shingle: int, percent: int
) -> RoundTable:
    """``(a, b, linked)`` for the pairs, by their whole sets.

    Only sets in a pair are sent, each once to the task of its cluster of pairs. The pairs of a cluster
    that is too large for a task are dealt out by one of their sets, the other, a hub of many pairs, is sent to all.
    """
    if not pairs.rows:
        return scratch.write(pairs.df.withColumn("linked", F.lit(False)))
    context = docs.sparkSession.sparkContext
    asked = pairs.df.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    chosen = scratch.write(sets.join(asked, "class").select("class", "doc_id", "text_hash", "n_shingles")).df
    wanted = context.broadcast(bitmap_of(chosen.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "text_hash")))
    clusters = components(scratch, pairs.df)
    sized = clusters.join(chosen.select("class", (F.col("n_shingles") * 8).alias("bytes")), "class")
    parts = F.ceil(F.sum("bytes") / CHECK_BYTES).cast("long")
    dealt = sized.groupBy("component").agg(parts.alias("parts"))
    placed = pairs.df.join(clusters.toDF("a", "component"), "a").join(dealt, "component")
    placed = scratch.write(
        placed.select("a", "b", "component", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    ).df
    needed = placed.select(F.explode(F.array("a", "b")).alias("class"), "component", "part").distinct()
    needed = scratch.write(
        needed.join(chosen.select("class", (F.col("n_shingles") * 8).alias("bytes")), "class"), bytes=F.sum("bytes")
    )
    tasks = max(1, -(-needed.counts["bytes"] // CHECK_BYTES))
    task = F.pmod(F.xxhash64("component", "part"), F.lit(tasks)).alias("task")
    elements = docs.mapInArrow(_elements(shingle, wanted), "class long, elements binary")
    sent = elements.join(needed.df.select("class", task).distinct(), "class")
    checked = scratch.write(
        placed.select("a", "b", task)
        .groupBy("task")
        .cogroup(sent.groupBy("task"))
        .applyInArrow(_linked(percent), "a long, b long, linked boolean")
    )
    wanted.unpersist()
    return checked


# -- the join --------------------------------------------------------------------------


def near_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``.

    A text's set is its distinct shingles of ``shingle`` words, or all its words as one if it has fewer. Two
    texts link when their sets' Jaccard similarity is ``percent`` hundredths or more; ``component_id`` is the
    smallest ``doc_id`` that links reach. NULL, empty and blank texts have no set and link with nothing; ties and
    repeated rows share a set and so a component; a component without any id has component NULL; an
    empty table gives no rows.

    Equal sets are one from the start. Of a signature a batch sends one set to a detecting task, whatever
    number shares it; large buckets are compared block by block. Exactness costs comparing
    all sets of a bucket, 30 nanoseconds a pair: a group of very many near copies that are just
    under the threshold takes time with its square, but only links leave the tasks.
    """
    return _grouped(docs, shingle, percent).select("doc_id", "n_shingles", "component_id")


def _grouped(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The columns of :func:`near_groups` and ``text_hash``, which tells texts of one id apart."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    rows, labels = _joined(scratch, docs, shingle, percent)
    firsts = (
        rows.where("class is not null")
        .groupBy("class")
        .agg(F.min("doc_id").alias("first"))
        .join(labels, "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    smallest = firsts.groupBy("component").agg(F.min("first").alias("component_id"))
    by_class = firsts.join(smallest, "component").select("class", "component_id")
    return rows.join(by_class, "class", "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def near_deduplicated(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group of :func:`near_groups`, that with the smallest id, with its own columns.

    Rows without a set or an id all stay; of rows that repeat the id that stays, all do. Where an id
    stands on several texts, each goes or stays by itself. Columns may have any names; an empty table gives no rows.
    """
    id_, hash_ = free_names(docs, "dropped_id", "dropped_hash")
    dropped = _grouped(docs, shingle, percent).where("doc_id is not null and doc_id != component_id")
    dropped = dropped.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).distinct()
    same = (F.col("doc_id") == F.col(id_)) & (_text_hash() == F.col(hash_))
    return docs.join(dropped.hint("merge"), same, "left_anti")


def _text_hash():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _joined(
    scratch: Scratch, docs: DataFrame, shingle: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", _text_hash().alias("text_hash")
    )
    described = scratch.write(
        docs.mapInArrow(_describe(shingle, percent), "doc_id long, text_hash long, " + SETS),
        elements=F.sum("n_shingles"),
        largest=F.max("n_shingles"),
    )
    rows = described.df
    first = F.min(F.struct("doc_id", "text_hash", "n_shingles", "sketch")).alias("first")
    sets = scratch.write(
        rows.where("class is not null").groupBy("class").agg(first).select("class", "first.*"),
        # The mean sketch of a signature: sets have signatures in proportion to their size.
        weight=F.sum(F.col("n_shingles") * F.octet_length("sketch")) / F.sum("n_shingles"),
    )
    weight, sets = max(SKETCH_BITS // 8, int(sets.counts["weight"])), sets.df
    if percent >= PARTITIONED:
        low = bands(described.counts["largest"], percent)
        signed, each = (lambda elements: signatures(elements, low, percent)), 0.4
    else:
        common = docs.sparkSession.sparkContext.broadcast(_common(scratch, docs, shingle))
        signed, each = (lambda elements: prefix(elements, *common.value, percent)), 1 - percent / 100
    parts = max(1, -(-int(described.counts["elements"] * each * 16) // GROUP_BYTES))
    members = (
        docs.select("text")
        .mapInArrow(_signer(signed, shingle, least_size(percent), parts), "part long, hot boolean, signatures binary, classes binary")
        .groupBy("part")
        .applyInArrow(_shared, "signature long, class long")
        .distinct()
    )
    members = scratch.write(members).df
    # Buckets with the same members are one bucket.
    content = members.groupBy("signature").agg(
        F.count(F.lit(1)).alias("members"),
        F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(F.xxhash64(F.col("class"), F.lit(1))).alias("xor"),
    )
    buckets = content.groupBy("members", "sum", "xor").agg(F.min("signature").alias("signature"))
    members = scratch.write(members.join(buckets.select("signature", "members"), "signature"))
    some = sets.select("class", "n_shingles", "sketch")

    groups = max(1, -(-members.rows * weight // SKETCH_BYTES))
    pairs = scratch.write(_compared(members.df, some, None, groups, percent))
    checked = _checked(scratch, docs, sets, pairs, shingle, percent)
    labels = components(scratch, checked.df.where("linked"))
    left = _compared(members.df, some, labels, groups, percent)
    more = scratch.write(left.join(checked.df, ["a", "b"], "left_anti"))
    if more.rows:
        checked_more = _checked(scratch, docs, sets, more, shingle, percent)
        labels = components(scratch, scratch.scan([checked, checked_more]).where("linked"))
    return rows, labels
