"""Quality classifier: byte filters over overlapping chunks of the whole text, max-pooled.

A chunk is two neighbouring blocks of bytes, so chunks overlap by half. A filter's largest
response in a chunk is the chunk's feature. The text's features are their maximum, minimum and
mean over all its chunks, and how full a short text's chunk is; a hidden layer and a logistic unit combine them into one probability.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootwise.llm.bytecnn import BLOCK, ByteFilters, adam, blocks_of, text_bytes
from rootwise.llm.hashing import shards

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILTERS = 24
FILTER_BYTES = 8
HIDDEN = 16
SHARD_BYTES = 1 << 20


class QualityNet:
    def __init__(self, seed: int = 11):
        self.conv = ByteFilters([FILTER_BYTES] * FILTERS, seed=seed)
        self.bias = np.zeros(FILTERS, np.float32)
        random = np.random.default_rng(seed)
        self.hidden = random.normal(0, (3 * FILTERS) ** -0.5, (3 * FILTERS + 1, HIDDEN)).astype(np.float32)
        self.hidden_bias = np.zeros(HIDDEN, np.float32)
        self.weight = random.normal(0, 0.1, HIDDEN).astype(np.float32)
        self.offset = np.zeros(1, np.float32)
        self.moments: dict = {}

    def _chunks(self, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First block of each chunk, and where each text's chunks begin.

        A text of n blocks has n - 1 chunks of two blocks; one of a single block has one chunk.
        """
        first = np.flatnonzero(np.append(owner[1:] == owner[:-1], False) | (np.bincount(owner)[owner] == 1))
        begins = np.searchsorted(owner[first], np.arange(owner[-1] + 1))
        return first, begins

    def _features(self, best: np.ndarray, owner: np.ndarray):
        first, begins = self._chunks(owner)
        second = np.minimum(first + 1, len(best) - 1)
        second = np.where(owner[second] == owner[first], second, first)
        chunk = np.maximum(best[first], best[second])
        active = np.maximum(chunk + self.bias, 0)
        counts = np.diff(begins, append=len(first))
        mean = np.add.reduceat(active, begins) / counts[:, None]
        most, least = np.maximum.reduceat(active, begins), np.minimum.reduceat(active, begins)
        return first, second, begins, counts, active, most, least, mean

    def _combined(self, most: np.ndarray, least: np.ndarray, mean: np.ndarray, sizes: np.ndarray):
        part = np.minimum(sizes, 2 * BLOCK)[:, None] / (2 * BLOCK)  # how full a short text's chunk is
        feature = np.hstack([most, least, mean, part]).astype(np.float32)
        hidden = np.maximum(feature @ self.hidden + self.hidden_bias, 0)
        return feature, hidden, _sigmoid(hidden @ self.weight + self.offset[0])

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The probability that a text is of quality 1, for every text."""
        if not len(texts):
            return np.empty(0)
        data, offsets = text_bytes(texts)
        rows, owner, _ = blocks_of(data, offsets, self.conv.reach)
        *_, most, least, mean = self._features(self.conv.maxima(rows), owner)
        return self._combined(most, least, mean, np.diff(offsets))[2].astype(float)

    def fit(
        self, texts: list[str], labels: np.ndarray, epochs: int, steps: int = 400, batch: int = 32, rate: float = 0.008
    ) -> None:
        """``epochs`` passes, or as many as make ``steps`` steps of a small sample."""
        epochs = max(epochs, min(100, -(-steps * batch // len(texts))))
        random = np.random.default_rng(5)
        step = 0
        for epoch in range(epochs):
            order = random.permutation(len(texts))
            pace = rate * (1 - epoch / epochs)
            for at in range(0, len(order), batch):
                chosen = order[at : at + batch]
                step += 1
                self._step([texts[i] for i in chosen], labels[chosen], pace, step)

    def _step(self, texts: list[str], labels: np.ndarray, rate: float, step: int) -> None:
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        rows, owner, _ = blocks_of(data, offsets, self.conv.reach)
        best, place = self.conv.maxima_and_places(rows)
        first, second, begins, counts, active, most, least, mean = self._features(best, owner)
        feature, hidden, score = self._combined(most, least, mean, np.diff(offsets))
        wrong = (score - labels) / len(labels)
        of_hidden = wrong[:, None] * self.weight * (hidden > 0)
        slope = of_hidden @ self.hidden.T
        text = np.repeat(np.arange(len(counts)), counts)
        of_chunk = slope[text, 2 * FILTERS : 3 * FILTERS] / counts[text, None]
        of_chunk += slope[text, :FILTERS] * (active == most[text])
        of_chunk += slope[text, FILTERS : 2 * FILTERS] * (active == least[text])
        of_chunk = (of_chunk * (active > 0)).astype(np.float32)
        of_block = np.zeros_like(best)
        from_first = best[first] >= best[second]
        np.add.at(of_block, first, of_chunk * from_first)
        np.add.at(of_block, second, of_chunk * ~from_first)
        self.conv.learn(rows, place, of_block, rate, step)
        adam(self, "bias", of_chunk.sum(axis=0), rate, step)
        adam(self, "hidden", feature.T @ of_hidden + 1e-4 * self.hidden, rate, step)
        adam(self, "hidden_bias", of_hidden.sum(axis=0), rate, step)
        adam(self, "weight", wrong @ hidden + 1e-4 * self.weight, rate, step)
        adam(self, "offset", np.array([wrong.sum()]), rate, step)


def _unlearned() -> QualityNet:
    """A network that scores every text 0.5."""
    net = QualityNet()
    net.weight[:] = 0
    return net


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def held_out(parts: int, remainder: int) -> Column:
    """True where ``crc32`` of the id as text leaves ``remainder``; an id that is NULL is held out."""
    left = F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == remainder
    return F.coalesce(left, F.lit(True))


def _slice(text: Column, most: int) -> Column:
    """A text of over ``most`` characters as a stretch of that length at a place set by its hash."""
    spare = F.greatest(F.length(text) - most, F.lit(0)) + 1
    return F.substring(text, (F.pmod(F.xxhash64(text), spare) + 1).cast("int"), F.lit(most))


def sampled(rows: DataFrame, most: int, among: DataFrame) -> DataFrame:
    """About ``most`` rows of ``rows``, told by a hash of their ids; ``among`` counts them."""
    share = min(1.0, most / max(1, among.count()))
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)


def train_quality(
    docs: DataFrame, labels: DataFrame, max_rows: int = 3000, max_chars: int = 24_000, epochs: int = 10
) -> bytes:
    """Learn from labelled documents that are not held out.

    The fit uses about ``max_rows`` of them, told by a hash of the id, and of a longer text a
    stretch of ``max_chars`` characters. It runs in one task, which that bound keeps small;
    the network alone reaches the driver. Of two labels that one id has, the lower counts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where(~held_out(3, 1) & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = sampled(known, max_rows, known)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("body")).join(chosen, "doc_id")
    rows = rows.select("doc_id", "label", _slice(F.coalesce("body", F.lit("")), max_chars).alias("body"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        net = _unlearned()
        if held:
            net = QualityNet()
            net.fit([row[2] for row in held], np.array([row[1] for row in held], float), epochs)
        net.moments, net.conv.moments = {}, {}
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(net)], pa.binary())], names=["net"])

    nets = rows.repartition(1).mapInArrow(fit, "net binary").collect()
    return bytes(nets[0]["net"]) if nets else cloudpickle.dumps(_unlearned())


def with_scores(docs: DataFrame, net: bytes) -> DataFrame:
    """``docs`` (which needs ``text``) with ``score``; the text itself does not come back from Python."""

    @F.pandas_udf("double")
    def score(texts):
        scorer = pickle.loads(net)
        batch = pa.RecordBatch.from_arrays([pa.Array.from_pandas(texts, type=pa.string())], names=["text"])
        import pandas as pd

        parts = [scorer.scores(part.column(0)) for part in shards([batch], "text", SHARD_BYTES)]
        return pd.Series(np.concatenate(parts) if parts else [])

    return docs.withColumn("score", score("text"))


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = 3000) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    ``score`` is the probability of quality 1, from the text's bytes alone; NULL and empty texts
    are scored as empty. An id that is NULL counts as held out. Labels other than 0 and 1, of
    unknown documents or given twice are passed over or used once; without any, every score is 0.5.
    Further columns are ignored. Scoring is one pass, row by row, a text's blocks a group at a
    time; nothing is shuffled.
    """
    net = train_quality(docs, labels, max_rows)
    scored = with_scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), net)
    return scored.select(
        "doc_id",
        held_out(3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def of_quality(docs: DataFrame, labels: DataFrame, max_rows: int = 3000) -> DataFrame:
    """The rows of ``docs`` that the classifier takes for quality 1, with their own columns, whatever their names.

    A score of exactly 0.5 stays, so without any label to learn from all rows do; NULL and empty texts have a
    score as well; repeated rows share one; an empty table gives no rows.
    """
    net = train_quality(docs, labels, max_rows)
    own = [F.col(f"`{name}`") for name in docs.columns]
    rows = with_scores(docs.select(F.struct(*own).alias("row"), "text"), net)
    return rows.where("score >= 0.5").select("row.*")
