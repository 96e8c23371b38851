"""A small byte-level convolutional network in numpy.

Bytes are embedded, filters slide over every byte, and the largest response of each filter
is taken over blocks of a fixed length. Filters may be of several widths: a narrow one is a
wide one with zeros behind. What is made of the blocks' maxima is left to the callers.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 256  # positions per block
GROUP = 96  # blocks whose responses are held at once


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and the ``n + 1`` places where texts begin and end; NULL is empty."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets


def blocks_of(data: np.ndarray, offsets: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rows, owner, used)``: blocks of ``BLOCK + reach`` bytes that cover every text.

    A block also shows the ``reach`` bytes that follow it; behind a text's end stand zeros.
    Every text has a block, an empty one too. ``used`` is a block's share of its text's bytes.
    """
    sizes = np.diff(offsets)
    count = np.maximum(1, -(-sizes // BLOCK))
    owner = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][owner] + nth * BLOCK
    left = offsets[1:][owner] - start
    if not len(data):
        data = np.zeros(1, np.uint8)
    place = start[:, None] + np.arange(BLOCK + reach)
    rows = data[np.minimum(place, len(data) - 1)]
    rows[np.arange(BLOCK + reach) >= left[:, None]] = 0
    return rows, owner, np.minimum(left, BLOCK)


class ByteFilters:
    """Embedding and filters; ``widths`` gives each filter's width."""

    def __init__(self, widths: list[int], size: int = 6, seed: int = 7):
        random = np.random.default_rng(seed)
        self.width, self.size = max(widths), size
        self.embedding = random.normal(0, 0.5, (256, size)).astype(np.float32)
        self.embedding[0] = 0
        used = np.repeat(np.arange(self.width)[:, None] < np.array(widths), size, axis=0)
        self.mask = used.astype(np.float32)
        scale = 1 / np.sqrt(np.array(widths) * size)
        self.filters = (random.normal(0, 1, used.shape) * scale * used).astype(np.float32)
        self.moments: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    @property
    def reach(self) -> int:
        return self.width - 1

    def _patches(self, rows: np.ndarray) -> np.ndarray:
        """Embedded bytes under the filters, one row per position."""
        seen = self.embedding[rows]
        view = np.lib.stride_tricks.as_strided(
            seen,
            (len(rows), BLOCK, self.width * self.size),
            (seen.strides[0], seen.strides[1], seen.itemsize),
        )
        return np.ascontiguousarray(view).reshape(len(rows) * BLOCK, -1)

    def maxima(self, rows: np.ndarray) -> np.ndarray:
        """The largest response of every filter in every block."""
        out = np.empty((len(rows), self.filters.shape[1]), np.float32)
        for at in range(0, len(rows), GROUP):
            part = rows[at : at + GROUP]
            response = self._patches(part) @ self.filters
            out[at : at + GROUP] = response.reshape(len(part), BLOCK, -1).max(axis=1)
        return out

    def maxima_and_places(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best = [
            (self._patches(rows[at : at + GROUP]) @ self.filters).reshape(-1, BLOCK, self.filters.shape[1])
            for at in range(0, len(rows), GROUP)
        ]
        place = np.concatenate([part.argmax(axis=1) for part in best])
        return np.concatenate([part.max(axis=1) for part in best]), place

    def learn(self, rows: np.ndarray, place: np.ndarray, slope: np.ndarray, rate: float, step: int) -> None:
        """One step down the slope of the loss with respect to the maxima."""
        seen = rows[np.arange(len(rows))[:, None, None], place[:, :, None] + np.arange(self.width)]
        patch = self.embedding[seen].reshape(*place.shape, -1)
        filters = np.einsum("bf,bfk->kf", slope, patch, optimize=True) * self.mask
        back = (slope[:, :, None] * self.filters.T[None]).reshape(-1, self.size)
        embedding = np.stack(
            [np.bincount(seen.ravel(), back[:, k], 256) for k in range(self.size)], axis=1
        ).astype(np.float32)
        embedding[0] = 0
        adam(self, "filters", filters, rate, step)
        adam(self, "embedding", embedding, rate, step)


def adam(model, name: str, slope: np.ndarray, rate: float, step: int) -> None:
    """One Adam step for ``model.<name>``; ``step`` counts from 1."""
    slope = slope.astype(np.float32)
    first, second = model.moments.get(name, (np.zeros_like(slope), np.zeros_like(slope)))
    first = 0.9 * first + 0.1 * slope
    second = 0.999 * second + 0.001 * slope * slope
    model.moments[name] = first, second
    moved = (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    setattr(model, name, (getattr(model, name) - rate * moved).astype(np.float32))
