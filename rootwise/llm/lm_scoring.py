"""Language-model scores of whole documents.

Words are counted over all training documents; the counts give the base score and the model's
vocabulary, classes and first biases. The recurrent model then learns from all
training documents: each task trains a copy, and the copies are averaged round by round. Scoring
runs over every text. Frequent words' counts travel to the tasks; a rare word's count
is joined by the word, so no table grows with the corpus in any one place.
"""

from __future__ import annotations

import math
import pickle
import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.llm import gru
from rootwise.llm.quality import held_out
from rootwise.scratch import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY = 2000  # ids of the model: the end, the most frequent words, and one for all others
KNOWN_WORDS = 200_000  # words whose counts every task holds
SLICE = 4 << 20  # bytes split at once
COUNTED_AT_ONCE = 16 << 20  # bytes of words
SCORED_AT_ONCE = 3_000_000  # tokens
LEARNED_AT_ONCE = 500_000
AVERAGED_AT_ONCE = 64
ROWS = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, tail double, "
    "n_tail long, model double, rare array<string>, times array<long>"
)


def _groups(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Rows that follow one another, some at a time: of more than one row the texts make up no more than a slice."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start = size = 0
    for at, own in enumerate(sizes.tolist()):
        if at > start and size + own > SLICE:
            yield batch.slice(start, at - start)
            start, size = at, 0
        size += own
    if start < len(sizes):
        yield batch.slice(start)


def _words(texts: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """The words of a group's texts, and whose each is; a text beyond a slice comes in pieces, cut between words.

    Arrow's ``ascii_`` functions and patterns of bytes know ASCII only.
    """
    if len(texts) > 1:
        yield _split(texts)
        return
    for text in texts:
        data = (text.as_py() or "").encode()
        at = 0
        while at < len(data):
            cut = re.compile(rb"[\x20\x09-\x0D]").search(data, at + SLICE)
            to = cut.start() if cut else len(data)
            yield _split(pa.array([data[at:to]], pa.binary()).cast(pa.string()))
            at = to


def _split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = lists.flatten()
    there = pc.not_equal(words, "")  # blanks at the ends leave empty ones
    owner = pc.list_parent_indices(lists).to_numpy()
    return owner[there.to_numpy(zero_copy_only=False)], words.filter(there)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Array] = []

    def counted() -> pa.RecordBatch:
        counts = pa.chunked_array(held, pa.string()).value_counts()
        return pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], names=["word", "n"])

    for batch in batches:
        for group in _groups(batch, 0):
            for _, words in _words(group.column(0)):
                held.append(words)
                if sum(h.nbytes for h in held) > COUNTED_AT_ONCE:
                    yield counted()
                    held.clear()
    yield counted()


class Vocabulary:
    """The counts that every task holds, most frequent word first, and sums over all words."""

    def __init__(self, words: list[str], counts: list[int], texts: int, tokens: int, distinct: int):
        self.packed = "\n".join(words)  # a word holds no line end
        self.counts = np.array(counts, np.int64)
        self.texts, self.tokens = texts, tokens
        self.distinct = distinct
        self.size = min(VOCABULARY - 1, len(words))
        named = int(self.counts[: self.size].sum()) + texts
        self.tail_tokens = tokens - named
        self.tail_distinct = distinct - self.size - (texts > 0)

    def words(self) -> pa.Array:
        return pa.array(self.packed.split("\n") if len(self.counts) else [], pa.string())

    def id_counts(self) -> np.ndarray:
        return np.concatenate([[self.texts], self.counts[: self.size], [self.tail_tokens]]).astype(float)


def count_words(scratch: Scratch, training: DataFrame):
    """The counts of all words of the training documents, a table, and the :class:`Vocabulary`."""
    texts = training.select("text")
    counted = scratch.write(
        texts.mapInArrow(_counter, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")),
        tokens=F.sum("n"),
    )
    documents = training.count()
    # The least count at which no more than KNOWN_WORDS words are left, from a histogram.
    step = F.floor(F.log2("n") * 16)
    histogram = counted.df.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least"))
    room, least = KNOWN_WORDS, None
    for row in sorted(histogram.collect(), reverse=True):
        room -= row["words"]
        if room < 0:
            break
        least = row["least"]
    known = counted.df.where(F.col("n") >= least if least is not None else F.lit(False)).toArrow()
    order = sorted(zip((-n for n in known["n"].to_pylist()), known["word"].to_pylist(), strict=True))
    vocabulary = Vocabulary(
        [word for _, word in order], [-n for n, _ in order], documents,
        counted.counts["tokens"] + documents, counted.rows + (documents > 0),
    )
    rest = counted.df.where(F.col("n") < least) if least is not None else counted.df
    return vocabulary, rest


# -- the model -------------------------------------------------------------------------


def _ranks(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Each word's place among the known ones, else -1."""
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy()


def _texts(n: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """The ids of ``n`` texts, an end behind each, of parts that say whose each id is."""
    ids = np.concatenate([np.empty(0, np.int32), *(ids for _, ids in parts)])
    upto = np.cumsum(sum((np.bincount(owner, minlength=n) for owner, _ in parts), np.zeros(n, np.int64)))
    return np.split(np.insert(ids, upto, 0), (upto + np.arange(1, n + 1))[:-1])


def _encoder(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        size = vocabulary.size
        named = vocabulary.words()[:size]
        for batch in batches:
            texts = []
            for group in _groups(batch, 0):
                found = [(owner, _ranks(words, named)) for owner, words in _words(group.column(0))]
                texts += _texts(len(group), [(owner, np.where(ranks < 0, size, ranks) + 1) for owner, ranks in found])
            texts = [ids.astype("<u2").tobytes() for ids in texts]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), batch.column(1)], names=["ids", "round"])

    return run


def _trainer(shared, counts: np.ndarray, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = gru.Gru(counts)
        model.set_parameters(shared.value)
        seen, held, tokens = 0, [], 0
        for batch in batches:
            for ids in batch.column(0):
                held.append(np.frombuffer(ids.as_py(), "<u2"))
                tokens += len(held[-1])
                if tokens > LEARNED_AT_ONCE:
                    seen += model.train(held, rate)
                    held, tokens = [], 0
        seen += model.train(held, rate)
        if seen:
            part = TaskContext.get().partitionId()
            yield _copy(part, seen, model.parameters())

    return run


def _copy(part: int, seen: int, values: list[np.ndarray]) -> pa.RecordBatch:
    packed = pa.array([pickle.dumps([v.astype(np.float32) for v in values])], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([seen]), packed], names=["part", "seen", "model"])


def _averaged(group: pa.Table) -> pa.Table:
    """One copy of a group's, weighted by the tokens each has seen."""
    total, seen = None, 0
    for copy in sorted(group.to_pylist(), key=lambda c: c["part"]):
        values = [v.astype(np.float64) * copy["seen"] for v in pickle.loads(copy["model"])]
        total = values if total is None else [a + b for a, b in zip(total, values, strict=True)]
        seen += copy["seen"]
    part = group["part"][0].as_py() // AVERAGED_AT_ONCE
    return pa.Table.from_batches([_copy(part, seen, [v / seen for v in total])])


def train_model(
    scratch: Scratch,
    training: DataFrame,
    vocabulary: Vocabulary,
    rounds: int = 3,
    rate: float = 0.009,
) -> list[np.ndarray]:
    """The model's parameters, learned from all training documents.

    Every text is used whole, in one of the rounds. The copies grow with the corpus; averages
    are formed 64 at a time.
    """
    spark = training.sparkSession
    counts = vocabulary.id_counts()
    model = gru.Gru(counts).parameters()
    texts = training.select("text", F.pmod(F.xxhash64("text"), F.lit(rounds)).alias("round"))
    shared = spark.sparkContext.broadcast(vocabulary)
    encoded = scratch.write(texts.mapInArrow(_encoder(shared), "ids binary, round long"), partition_by=("round",)).df
    for number in range(rounds):
        current = spark.sparkContext.broadcast(model)
        copies = scratch.write(
            encoded.where(F.col("round") == number)
            .select("ids")
            .mapInArrow(_trainer(current, counts, rate * 0.5**number), "part long, seen long, model binary")
        )
        while copies.rows > 1:
            grouped = copies.df.groupBy(F.expr(f"part div {AVERAGED_AT_ONCE}"))
            copies = scratch.write(grouped.applyInArrow(_averaged, "part long, seen long, model binary"))
        if copies.rows:
            model = pickle.loads(copies.df.collect()[0]["model"])
    return model


# -- scoring ---------------------------------------------------------------------------


def _scorer(shared, model_shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        known_words = vocabulary.words()
        model = gru.Gru(vocabulary.id_counts())
        model.set_parameters(model_shared.value)
        logs = np.append(np.log10(vocabulary.counts + 1.0), 0.0)  # the last is for rank -1
        end = math.log10(vocabulary.texts + 1)
        size = vocabulary.size
        row = TaskContext.get().partitionId() << 40
        held: list[tuple] = []
        waiting: list[np.ndarray] = []
        tokens = 0

        def scored() -> pa.RecordBatch:
            results = model.score(waiting)
            rows = [(*own[:8], float(result), *own[8:]) for own, result in zip(held, results, strict=True)]
            fields = [field.split() for field in ROWS.split(", ")]
            kinds = {
                "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(),
                "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()),
            }
            columns = zip(*rows, strict=True)
            arrays = [pa.array(column, kinds[kind]) for (_, kind), column in zip(fields, columns, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])

        for batch in batches:
            for group in _groups(batch, 2):
                rows = len(group)
                known, n_tail, n = (np.zeros(rows, np.int64) for _ in range(3))
                base, tail = np.zeros(rows), np.zeros(rows)
                parts, rare = [], [Counter() for _ in range(rows)]
                for owner, words in _words(group.column(2)):
                    found = _ranks(words, known_words)
                    value, beyond, unknown = logs[found], found >= size, found < 0
                    n += np.bincount(owner, minlength=rows)
                    known += np.bincount(owner[~unknown], minlength=rows)
                    base += np.bincount(owner, value, rows)
                    tail += np.bincount(owner[beyond], value[beyond], rows)
                    n_tail += np.bincount(owner[beyond | unknown], minlength=rows)
                    parts.append((owner, np.where(beyond | unknown, size + 1, found + 1)))
                    for place, word in zip(owner[unknown].tolist(), words.filter(pa.array(unknown)).to_pylist(), strict=True):
                        rare[place][word] += 1
                ids = _texts(rows, parts)
                columns = (x.to_pylist() for x in (group.column(0), group.column(1)))
                figures = (x.tolist() for x in (n + 1, known + (vocabulary.texts > 0), base + end, tail, n_tail))
                for doc_id, out, *own, words in zip(*columns, *figures, rare, strict=True):
                    held.append((row, doc_id, out, *own, list(words), list(words.values())))
                    row += 1
                waiting += ids
                tokens += sum(len(x) for x in ids)
                if tokens > SCORED_AT_ONCE:
                    yield scored()
                    held, waiting, tokens = [], [], 0
        if held:
            yield scored()

    return run


def lm_scores(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs``.

    Tokens are a text's words, ``A-Z`` in lower case, and one end; NULL and empty texts are the
    end alone. ``base_score`` is the sum of ``log10((c + 1) / (N + V + 1))``, with counts over all training
    documents. ``score`` is the model's log10 probability: the recurrent model gives
    frequent words their probability, and all others that of their kind, times
    ``(c + 1) / (N' + V' + 1)`` with counts among that kind. An id that is NULL counts as held out;
    repeated rows are each counted and scored; an empty table gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.select("doc_id", held_out(7, 2).alias("held_out"), "text")
    training = docs.where("not held_out")
    vocabulary, rest = count_words(scratch, training)
    model = train_model(scratch, training, vocabulary)
    shared, model_shared = spark.sparkContext.broadcast(vocabulary), spark.sparkContext.broadcast(model)
    rows = scratch.write(docs.mapInArrow(_scorer(shared, model_shared), ROWS)).df
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("word"), F.col("x.times").alias("times")
    )
    found = (
        rare.join(rest, "word")
        .groupBy("row")
        .agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"))
    )
    more = F.coalesce("more", F.lit(0.0))
    all_words = math.log10(vocabulary.tokens + vocabulary.distinct + 1)
    tail_words = math.log10(vocabulary.tail_tokens + vocabulary.tail_distinct + 1)
    return rows.drop("rare", "times").join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * all_words).alias("base_score"),
        (F.col("model") / math.log(10) + F.col("tail") + more - F.col("n_tail") * tail_words).alias("score"),
    )
