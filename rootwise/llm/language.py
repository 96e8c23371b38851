"""Language identification: byte filters of several widths, max-pooled, and a softmax.

A text is cut into windows of 256 bytes, all of them; each window's filter maxima give the
probabilities of the languages, and the text's are the mean over its windows by their bytes.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.llm.bytecnn import ByteFilters, adam, blocks_of, text_bytes
from rootwise.llm.hashing import shards
from rootwise.llm.quality import SHARD_BYTES, _slice, held_out
from rootwise.scratch import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTHS = [2] * 6 + [3] * 8 + [4] * 8 + [5] * 10


class LanguageNet:
    def __init__(self, languages: list[str], seed: int = 3):
        self.languages = languages
        self.conv = ByteFilters(WIDTHS, seed=seed)
        self.bias = np.zeros(len(WIDTHS), np.float32)
        self.weight = np.zeros((len(WIDTHS), max(1, len(languages))), np.float32)
        self.offset = np.zeros(max(1, len(languages)), np.float32)
        self.moments: dict = {}

    def _windows(self, best: np.ndarray) -> np.ndarray:
        x = np.maximum(best + self.bias, 0) @ self.weight + self.offset
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return x / x.sum(axis=1, keepdims=True)

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of the likeliest language of every text, and its probability."""
        data, offsets = text_bytes(texts)
        rows, owner, used = blocks_of(data, offsets, self.conv.reach)
        shown = self._windows(self.conv.maxima(rows)).astype(float)
        weight = np.maximum(used, 1).astype(float)
        begins = np.searchsorted(owner, np.arange(len(texts)))
        mean = np.add.reduceat(shown * weight[:, None], begins) / np.add.reduceat(weight, begins)[:, None]
        most = mean.argmax(axis=1)
        return most, np.minimum(1.0, mean[np.arange(len(mean)), most])

    def fit(
        self, texts: list[str], labels: np.ndarray, epochs: int, steps: int = 1000, batch: int = 128, rate: float = 0.004
    ) -> None:
        """``epochs`` passes, or as many as make ``steps`` steps of a small sample."""
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        rows, owner, used = blocks_of(data, offsets, self.conv.reach)
        rows, label = rows[used > 0], labels[owner[used > 0]]
        epochs = max(epochs, min(100, -(-steps * batch // max(1, len(rows)))))
        random = np.random.default_rng(5)
        step = 0
        for epoch in range(epochs):
            order = random.permutation(len(rows))
            pace = rate * (1 - epoch / epochs)
            for at in range(0, len(order), batch):
                chosen = order[at : at + batch]
                step += 1
                self._step(rows[chosen], label[chosen], pace, step)

    def _step(self, rows: np.ndarray, label: np.ndarray, rate: float, step: int) -> None:
        best, place = self.conv.maxima_and_places(rows)
        feature = np.maximum(best + self.bias, 0)
        wrong = self._windows(best)
        wrong[np.arange(len(label)), label] -= 1
        wrong /= len(label)
        slope = ((wrong @ self.weight.T) * (feature > 0)).astype(np.float32)
        self.conv.learn(rows, place, slope, rate, step)
        adam(self, "bias", slope.sum(axis=0), rate, step)
        adam(self, "weight", feature.T @ wrong + 1e-4 * self.weight, rate, step)
        adam(self, "offset", wrong.sum(axis=0), rate, step)


def train_languages(
    docs: DataFrame, per_language: int = 400, max_chars: int = 1024, epochs: int = 6, max_rows: int = 20_000
) -> bytes:
    """Learn from documents with a language that are not held out.

    The fit uses about ``per_language`` documents of each language, told by a hash of id and text,
    and of a longer text a stretch of ``max_chars`` characters. It runs in one task, which
    that bound keeps small: if there are very many languages, they share ``max_rows`` documents. Languages are
    counted first, so a rare one is not lost; the counts are joined, however many they are.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(5, 0)
    )
    counts = Scratch(docs.sparkSession, "languages").write(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("of_lang")))
    quota = min(per_language, max_rows / max(1, counts.rows))
    bound = F.floor(F.least(F.lit(1.0), F.lit(float(quota)) / F.col("of_lang")) * 1_000_000) + 1
    rows = rows.join(counts.df, "lang").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < bound)
    rows = rows.select("doc_id", "lang", _slice(F.col("text"), max_chars).alias("body"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted(
            (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)),
            key=str,
        )
        names, labels = np.unique([row[1] for row in held], return_inverse=True) if held else ([], None)
        net = LanguageNet([str(name) for name in names])
        if held:
            net.fit([row[2] for row in held], labels, epochs)
        net.moments, net.conv.moments = {}, {}
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(net)], pa.binary())], names=["net"])

    nets = rows.repartition(1).mapInArrow(fit, "net binary").collect()
    return bytes(nets[0]["net"]) if nets else cloudpickle.dumps(LanguageNet([]))


def languages(docs: DataFrame, per_language: int = 400) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per row of ``docs``.

    ``lang_pred`` is one of the languages learned, or ``und`` with score 0 for a text that is
    NULL, has no letter, or when nothing could be learned. ``score`` is the probability of the
    prediction. An id that is NULL counts as held out. Only the text's bytes are looked at; all
    its windows count. One pass, row by row; nothing is shuffled.
    """
    net = train_languages(docs, per_language)

    @F.pandas_udf("lang string, score double")
    def predict(texts):
        import pandas as pd

        known = pickle.loads(net)
        batch = pa.RecordBatch.from_arrays([pa.Array.from_pandas(texts, type=pa.string())], names=["text"])
        parts = [known.predict(part.column(0)) for part in shards([batch], "text", SHARD_BYTES)]
        names = np.array(known.languages or ["und"], object)
        return pd.DataFrame(
            {
                "lang": np.concatenate([names[most] for most, _ in parts]) if parts else [],
                "score": np.concatenate([score for _, score in parts]) if parts else [],
            }
        )

    told = F.col("text").rlike(r"\p{L}") & (F.col("p.lang") != "und")
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("p", predict("text"))
        .select(
            "doc_id",
            held_out(5, 0).alias("held_out"),
            F.when(told, F.col("p.lang")).otherwise("und").alias("lang_pred"),
            F.when(told, F.col("p.score")).otherwise(0.0).alias("score"),
        )
    )
