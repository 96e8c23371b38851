"""Words of many texts as 64-bit numbers, by whole-array steps over their UTF-8 bytes."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 2 << 20  # bytes cut into words at once


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(32))


class WordHasher:
    """Cuts texts into words of the bytes in ``word_bytes``; ``A-Z`` count as ``a-z``."""

    def __init__(self, word_bytes: np.ndarray):
        self.is_word = word_bytes
        values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for upper in range(ord("A"), ord("Z") + 1):
            values[upper] = values[upper + 32]
        self.values = np.where(word_bytes, values, np.uint64(0))
        self.powers = self._powers(256)

    @staticmethod
    def _powers(n: int) -> np.ndarray:
        base = np.full(n, 0xD6E8FEB86659FD93, np.uint64)
        base[0] = 1
        with np.errstate(over="ignore"):
            return np.multiply.accumulate(base)

    @classmethod
    def letters_and_digits(cls) -> WordHasher:
        """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing."""
        ok = np.zeros(256, bool)
        ok[128:] = True
        for low, high in ("09", "az", "AZ"):
            ok[ord(low) : ord(high) + 1] = True
        return cls(ok)

    @classmethod
    def unbroken(cls) -> WordHasher:
        """Words ``[^\\x20\\x09-\\x0D]+``."""
        ok = np.ones(256, bool)
        ok[[0x20, *range(0x09, 0x0E)]] = False
        return cls(ok)

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, text after text, and how many words each text has.

        Words are as good as equal when their hashes are: no two of 10**8 different words
        share one, but with a probability of 1 in 3,000. NULL has no words.
        """
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        counts = np.zeros(len(texts), np.int64)
        found = []
        at = int(offsets[0]) if len(texts) else 0
        end = int(offsets[-1]) if len(texts) else 0
        while at < end:
            to = min(end, at + CHUNK)
            while to < end and self.is_word[data[to]] and self.is_word[data[to - 1]]:
                to += 1  # end a chunk between words
            hashes, starts = self._chunk(data[at:to], offsets[(offsets >= at) & (offsets < to)] - at)
            if len(starts):
                owner = np.searchsorted(offsets, starts + at, side="right") - 1
                counts += np.bincount(owner, minlength=len(texts))
                found.append(hashes)
            at = to
        return (np.concatenate(found) if found else np.empty(0, np.uint64)), counts

    def _chunk(self, data: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        word = self.is_word[data]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        begins[text_starts] = word[text_starts]
        starts = np.flatnonzero(begins)
        if not len(starts):
            return np.empty(0, np.uint64), starts
        lengths = np.diff(starts, append=len(data))
        place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
        longest = int(lengths.max())
        if longest > len(self.powers):
            self.powers = self._powers(2 * longest)
        with np.errstate(over="ignore"):
            terms = self.values[data[starts[0] :]] * self.powers[place]
            return mix(np.add.reduceat(terms, starts - starts[0])), starts


def shards(
    batches: Iterator[pa.RecordBatch], column: str, shard_bytes: int
) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``shard_bytes`` of text; a longer text is a batch by itself."""
    for batch in batches:
        texts = batch.column(column)
        sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        upto = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, done + shard_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to
