"""Phrase collocations by vertically partitioned, depth-truncated suffix subtrees.

A text's suffixes start at its words and are cut off after ``max_words`` words, at the end of a piece
and before a word too rare for any candidate. They fall into groups by their first words:
prefixes are counted, one that occurs too often for a group's budget is lengthened by a word, and
prefixes are put into as many groups as keep the mean group far below it. A group's suffixes, sorted,
are its subtrees; they are built independently, and a node's count is the sum of its leaves' totals.

Counts decide the rest as joins: a candidate meets the counts of its parts, and longer ones
count for the phrases inside them.

What every task has to know about all words are two bitmaps of fixed size. A word that falls on
a rarer one's bit is only cut off, or its prefix lengthened, for nothing; counts stay exact.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rootwise.llm.bitmaps import bitmap_of, held_by, joint_key
from rootwise.llm.hashing import CHUNK, WordHasher, mix, shards
from rootwise.scratch import RoundTable, Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_WORDS = 2
MAX_WORDS = 3
MIN_COUNT = 10
INSIDE_PERCENT = 50  # of a phrase's occurrences inside a longer candidate, from which on it goes
TOP = 2000
UNKNOWN = "und"
SCALE = 1_000_000

SHARD_BYTES = 4 << 20
HELD_TYPES = 2_000_000  # words that a task counts before it hands them on
HELD_SUFFIXES = 1_000_000  # suffixes that a task sorts at once: some 150 MB with all that is made of them
GROUP_SUFFIXES = 500_000  # suffixes in a group, in the mean
# A prefix is lengthened from so many occurrences on, or from this share of all words if that is less.
LONG_PREFIX = GROUP_SUFFIXES
LONG_SHARE = 1 / 2000
PREFIX_BITS = 28  # of a prefix's hash, which say the group
SALTS = 8

# What ends a piece, and what separates its words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BETWEEN = b" \t"


# -- words -----------------------------------------------------------------------------


class PieceHasher(WordHasher):
    """Words as :class:`WordHasher` cuts them, with their places and the pieces they stand in."""

    @classmethod
    def of_pieces(cls) -> PieceHasher:
        ok = np.ones(256, bool)
        ok[list(PIECE_ENDS + BETWEEN)] = False
        hasher = cls(ok)
        hasher.ends = np.zeros(256, bool)
        hasher.ends[list(PIECE_ENDS)] = True
        return hasher

    def placed(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``hash, start, piece`` of every word of the texts that lie at ``offsets`` of ``data``.

        Words of one piece of one text, and no others, have the same ``piece``.
        """
        found, pieces = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))], 0
        at, end = int(offsets[0]), int(offsets[-1])
        while at < end:
            to = min(end, at + CHUNK)
            while to < end and self.is_word[data[to]] and self.is_word[data[to - 1]]:
                to += 1  # end a chunk between words
            begins = offsets[(offsets >= at) & (offsets < to)] - at
            hashes, starts = self._chunk(data[at:to], begins)
            breaks = self.ends[data[at:to]]
            breaks[begins] = True  # what stands before a text's first byte is another piece
            upto = np.cumsum(breaks) + pieces
            found.append((hashes, starts + at, upto[starts]))
            pieces, at = int(upto[-1]), to
        return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def _placed_words(batch: pa.RecordBatch, hasher: PieceHasher):
    """``word, start, piece, text`` of a batch; ``word`` is a hash of the word and its text's language."""
    data, offsets = _bytes_of(batch.column("text"))
    hashes, starts, pieces = hasher.placed(data, offsets)
    texts = np.searchsorted(offsets, starts, side="right") - 1
    language = batch.column("lang_hash").to_numpy().view(np.uint64)
    return mix(hashes ^ language[texts]), starts, pieces, texts


def _types(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different word stands first, and each word's number among these."""
    index = pa.array(words).dictionary_encode().indices.to_numpy()
    new = np.maximum.accumulate(index)
    return np.flatnonzero(np.diff(new, prepend=-1)), index


def _gathered(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The stretches of ``data`` as strings."""
    lengths = end - begin
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    place = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], lengths)
    kept = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[place])]
    return pa.Array.from_buffers(pa.large_string(), len(begin), kept)


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(word, n, lang, text)`` of the different words of a task's texts."""
    hasher = PieceHasher.of_pieces()
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    held: list[pa.Table] = []

    def flush() -> pa.RecordBatch:
        table = pa.concat_tables(held)
        first, index = _types(table["word"].to_numpy())
        n = np.bincount(index, table["n"].to_numpy()).astype(np.int64)  # below 2**53
        rows = table.take(pa.array(first))
        columns = [rows["word"], pa.chunked_array([n]), rows["lang"].cast(pa.string()), rows["text"].cast(pa.string())]
        return pa.table(columns, names=["word", "n", "lang", "text"]).combine_chunks().to_batches()[0]

    for batch in shards(batches, "text", SHARD_BYTES):
        words, starts, _, texts = _placed_words(batch, hasher)
        if not len(words):
            continue
        first, index = _types(words)
        data, offsets = _bytes_of(batch.column("text"))
        gaps = np.append(np.flatnonzero(~hasher.is_word[data[: offsets[-1]]]), offsets[-1])
        begin, owner = starts[first], texts[first]
        end = np.minimum(gaps[np.searchsorted(gaps, begin)], offsets[owner + 1])
        columns = {
            "word": pa.array(words[first].view(np.int64)),
            "n": pa.array(np.bincount(index)),
            "lang": batch.column("lang").take(pa.array(owner)).cast(pa.large_string()),
            "text": _gathered(lower[data], begin, end),
        }
        held.append(pa.table(columns))
        if sum(map(len, held)) >= HELD_TYPES:
            yield flush()
            held = []
    if held:
        yield flush()


# -- suffixes --------------------------------------------------------------------------


def _suffixes(words: np.ndarray, pieces: np.ndarray, frequent: np.ndarray, depth: int) -> list[np.ndarray]:
    """The suffixes of two or more words, a column a word, 0 after a suffix's end."""
    n = len(words)
    good = held_by(frequent, words)
    alive = good.copy()
    columns = [words]
    for step in range(1, depth):
        following = np.zeros(n, np.uint64)
        if step < n:
            alive[: n - step] &= good[step:] & (pieces[step:] == pieces[: n - step])
        alive[max(0, n - step) :] = False
        following[alive] = words[np.flatnonzero(alive) + step]
        columns.append(following)
    long = columns[1] != 0
    return [column[long] for column in columns]


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    """Where rows differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def _held_suffixes(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, depth: int, wanted=None):
    """The suffixes of a task's texts, a good many at a time; ``wanted`` says which."""
    hasher = PieceHasher.of_pieces()
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in shards(batches, "text", SHARD_BYTES):
        words, _, pieces, _ = _placed_words(batch, hasher)
        columns = _suffixes(words, pieces, frequent, depth)
        if wanted is not None:
            some = wanted(columns)
            columns = [column[some] for column in columns]
        held.append(columns)
        size += len(columns[0])
        if size >= HELD_SUFFIXES:
            yield _joined(held)
            size = 0
    if size:
        yield _joined(held)


def _joined(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    """The columns in one, taken off ``held``: nothing of it stays while they are worked on."""
    columns = [np.concatenate(column) for column in zip(*held, strict=True)]
    held.clear()
    return columns


def _long_prefixes(filters, length: int):
    """A task's function: how often prefixes of ``length`` words occur, if all shorter ones occur too often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, *heavy = filters.value

        def wanted(columns: list[np.ndarray]) -> np.ndarray:
            return (columns[length - 1] != 0) & (_prefix_lengths(columns, heavy) == length)

        for columns in _held_suffixes(batches, frequent, length, wanted):
            first, index = _types(joint_key(columns))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c[first].view(np.int64)) for c in columns), pa.array(np.bincount(index))],
                names=[*(f"w{i}" for i in range(length)), "n"],
            )

    return run


def _prefix_lengths(columns: list[np.ndarray], heavy: list[np.ndarray]) -> np.ndarray:
    """The number of words in each suffix's prefix: the shortest that doesn't occur too often."""
    lengths = np.ones(len(columns[0]), np.int64)
    for level, bitmap in enumerate(heavy, 1):
        longer = (lengths == level) & held_by(bitmap, joint_key(columns[:level]))
        lengths[longer] = level + 1
    return lengths


def _to_groups(filters, depth: int, groups: int):
    """A task's function: its suffixes, by the group of their prefix, as sorted blocks.

    A group is a range of prefix hashes. Suffixes are sorted by a number whose first bits are their prefix's
    hash and whose others are those of longer and longer beginnings, so equal beginnings stand together. Where
    two have one number, a suffix may be counted in two rows: groups add them up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, *heavy = filters.value
        for columns in _held_suffixes(batches, frequent, depth):
            lengths = _prefix_lengths(columns, heavy)
            prefix = np.empty(len(lengths), np.uint64)
            for length in range(1, len(heavy) + 2):
                mine = lengths == length
                prefix[mine] = mix(joint_key([column[mine] for column in columns[:length]]) + np.uint64(length))
            number, free = prefix >> np.uint64(64 - PREFIX_BITS) << np.uint64(64 - PREFIX_BITS), 64 - PREFIX_BITS
            width = free // (depth - 1)
            for level in range(2, depth + 1):
                free -= width
                number |= mix(joint_key(columns[:level])) >> np.uint64(64 - width) << np.uint64(free)
            order = np.argsort(number)
            columns = [column[order] for column in columns]
            starts = np.flatnonzero(_changes(columns))
            n = np.diff(starts, append=len(order))
            columns = [column[starts] for column in columns]
            first = (number[order][starts] >> np.uint64(64 - PREFIX_BITS)).astype(np.int64)
            group = first * groups >> PREFIX_BITS
            cuts = np.flatnonzero(np.diff(group, prepend=-1))
            for at, to in zip(cuts, np.append(cuts[1:], len(group)), strict=True):
                block = _packed([column[at:to] for column in columns], n[at:to])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(group[at])], pa.int64()), pa.array([block], pa.list_(pa.binary()))],
                    names=["group", "block"],
                )

    return run


def _packed(columns: list[np.ndarray], n: np.ndarray) -> list[bytes]:
    """Sorted suffixes with every shared beginning once, and how far it goes."""
    out = []
    for level in range(1, len(columns)):
        starts = np.flatnonzero(_changes(columns[:level]))
        out += [columns[level - 1][starts].tobytes(), np.diff(starts, append=len(n)).astype("<u4").tobytes()]
    return [*out, columns[-1].tobytes(), n.astype("<u4").tobytes()]


def _unpacked(block: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    columns = []
    for values, runs in zip(block[:-2:2], block[1:-2:2], strict=True):
        columns.append(np.repeat(np.frombuffer(values, np.uint64), np.frombuffer(runs, "<u4")))
    return [*columns, np.frombuffer(block[-2], np.uint64)], np.frombuffer(block[-1], "<u4").astype(np.int64)


def _subtrees(filters, min_count: int):
    """A group's subtrees: the inner nodes and leaves that occur often, with their words."""

    def run(group: pa.Table) -> pa.Table:
        blocks = [_unpacked(block) for block in group["block"].to_pylist()]
        columns = [np.concatenate(column) for column in zip(*(c for c, _ in blocks), strict=True)]
        n = np.concatenate([n for _, n in blocks])
        order = np.lexsort(columns[::-1])
        columns, n = [column[order] for column in columns], n[order]
        lengths = _prefix_lengths(columns, filters.value[1:])
        words, counts = [], []
        for level in range(2, len(columns) + 1):
            starts = np.flatnonzero(_changes(columns[:level]))
            totals = np.add.reduceat(n, starts)
            # Above a group's prefix a node has leaves in other groups: it is counted with the prefixes.
            often = (totals >= min_count) & (columns[level - 1][starts] != 0) & (lengths[starts] <= level)
            found = np.stack([column[starts[often]] for column in columns[:level]], axis=1)
            words += found.view(np.int64).tolist()
            counts += totals[often].tolist()
        return pa.table({"words": pa.array(words, pa.list_(pa.int64())), "n": pa.array(counts, pa.int64())})

    return run


def _split_above(filters, level: int):
    """A task's function: counted prefixes of ``level`` words that were lengthened."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [column.to_numpy() for column in batch.columns[:level]]
            own = held_by(filters.value[level], joint_key([w.view(np.uint64) for w in words]))
            found = np.stack([w[own] for w in words], axis=1).tolist()
            columns = [pa.array(found, pa.list_(pa.int64())), batch.column("n").filter(pa.array(own))]
            yield pa.RecordBatch.from_arrays(columns, names=["words", "n"])

    return run


def _nodes(scratch: Scratch, docs: DataFrame, words: RoundTable, depth: int, min_count: int) -> RoundTable:
    """``(words, n)`` of all phrases of 1 to ``depth`` words that occur ``min_count`` times or more."""
    context = docs.sparkSession.sparkContext
    often = words.df.where(F.col("n") >= min_count)
    filters = [bitmap_of(often.select("word"))]
    prefixes, tables = words.df.select(F.col("word").alias("w0"), "n"), [words]
    long = max(1, min(LONG_PREFIX, int(words.counts["all"] * LONG_SHARE)))
    for length in range(1, depth):
        if (tables[-1].counts["most"] or 0) < long:
            break
        names = [f"w{i}" for i in range(length + 1)]
        filters.append(bitmap_of(prefixes.where(F.col("n") >= long).select(*names[:-1])))
        if length + 1 == depth:
            break
        schema = ", ".join(f"{name} long" for name in [*names, "n"])
        counted = docs.mapInArrow(_long_prefixes(context.broadcast(filters), length + 1), schema)
        tables.append(scratch.write(counted.groupBy(*names).agg(F.sum("n").alias("n")), most=F.max("n")))
        prefixes = tables[-1].df
    spread = context.broadcast(filters)
    found = often.select(F.array("word").alias("words"), "n")
    node = "words array<long>, n long"
    for level in range(2, len(filters)):
        above = tables[level - 1].df.where(F.col("n") >= min_count)
        found = found.unionByName(above.mapInArrow(_split_above(spread, level), node))
    groups = max(1, -(-words.counts["often"] // GROUP_SUFFIXES))
    blocks = docs.mapInArrow(_to_groups(spread, depth, groups), "group long, block array<binary>")
    found = found.unionByName(blocks.groupBy("group").applyInArrow(_subtrees(spread, min_count), node))
    return scratch.write(found)


# -- the operator ----------------------------------------------------------------------


def collocations(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    inside_percent: int = INSIDE_PERCENT,
    top: int = TOP,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the strongest phrases of every language of ``docs``.

    Texts are cut at ``.,;:!?`` and line ends into pieces, pieces at spaces and tabs into words; ``A-Z`` count
    as ``a-z``. Per ``lang`` (NULL is ``und``) ``n`` is the number of words, ``a`` how often the phrase stands
    in pieces. Candidates have ``min_words`` to ``max_words`` words and ``a >= min_count``. A cut into two parts
    that occur ``l`` and ``r`` times scores ``floor(1000000 a a / (l r))``; the lowest-scoring cut counts,
    of ties that with the shortest first part. A candidate goes if ``inside_percent`` hundredths of it
    stand inside one longer candidate. Each language's first ``top`` come by score, count, then phrase.

    NULL and empty texts have no words; repeated rows count again; a language without candidates and an empty
    table give no rows; ``doc_id`` and other columns are not read. Words are told apart by 64-bit hashes of word and
    language: of 10**8 words two share one with a probability of 1 in 3,000.
    """
    if not 2 <= min_words <= max_words:
        raise ValueError("phrases have two words or more, and max_words is not below min_words")
    scratch = Scratch(docs.sparkSession, "phrases")
    lang = F.coalesce("lang", F.lit(UNKNOWN))
    read = docs.select("text", lang.alias("lang"), F.xxhash64(lang).alias("lang_hash"))
    counted = read.mapInArrow(_counted_words, "word long, n long, lang string, text string")
    words = scratch.write(
        counted.groupBy("word", "lang", "text").agg(F.sum("n").alias("n")),
        often=F.sum(F.when(F.col("n") >= min_count, F.col("n")).otherwise(0)),
        all=F.sum("n"),
        most=F.max("n"),
    )
    nodes = _nodes(scratch, read.select("text", "lang_hash"), words, max_words, min_count).df
    scored = scratch.write(_scored(nodes, min_words)).df
    longer = _longest_holder(scored.select("words", "a"), min_words)
    kept = scored.join(longer, "words", "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside_percent)
    )
    return _ranked(kept.drop("longer"), words.df, top)


def _scored(nodes: DataFrame, min_words: int) -> DataFrame:
    """``(words, a, score, l, r)`` of all candidates, by their weakest cut."""
    size = F.size("words")
    cuts = nodes.where(size >= min_words).withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select(
        "words",
        F.col("n").alias("a"),
        "k",
        F.slice("words", F.lit(1), F.col("k")).alias("first"),
        F.slice("words", F.col("k") + 1, size - F.col("k")).alias("rest"),
    )
    both = cuts.join(nodes.toDF("first", "l"), "first").join(nodes.toDF("rest", "r"), "rest")
    a, l, r = (f"cast({name} as decimal(38,0))" for name in "alr")
    score = F.expr(f"({SCALE} * {a} * {a}) div ({l} * {r})")
    weakest = both.groupBy("words").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"), F.max("a").alias("a"))
    return weakest.select("words", "a", "cut.score", "cut.l", "cut.r")


def _longest_holder(candidates: DataFrame, min_words: int) -> DataFrame:
    """``(words, longer)``: how often the commonest longer candidate occurs that a phrase lies in."""
    parts = F.expr(
        f"""explode(flatten(transform(sequence({min_words}, size(words) - 1),
            m -> transform(sequence(1, size(words) - m + 1), at -> slice(words, at, m)))))"""
    )
    inside = candidates.where(F.size("words") > min_words).select(parts.alias("words"), "a")
    return inside.groupBy("words").agg(F.max("a").alias("longer"))


def _ranked(kept: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of every language, with their words."""
    spelled = (
        kept.withColumn("key", F.col("words"))
        .select("key", "a", "l", "r", "score", F.posexplode("words").alias("at", "word"))
        .join(words.select("word", "lang", "text"), "word")
        .groupBy("key", "a", "l", "r", "score", "lang")
        .agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("spelled"))
        .withColumn("phrase", F.array_join("spelled.text", " "))
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # A language's candidates in parts first: of each only the first can be among its first.
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = spelled.withColumn("part", part).withColumn(
        "nth", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return (
        first.where(F.col("nth") <= top)
        .withColumn("rank", rank)
        .where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
