"""Bitmaps of fixed size that tell tasks which keys may be in a table of any size.

A key that is there is always found. One that is not may fall on the same bit: whoever asks has to
be right either way, and only does some work for nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from rootwise.llm.hashing import mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILTER_BITS = 1 << 26
SEGMENT_BITS = 1 << 18


def joint_key(columns: list[np.ndarray]) -> np.ndarray:
    """One 64-bit number for the numbers of a row."""
    key = columns[0]
    with np.errstate(over="ignore"):
        for column in columns[1:]:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key


def _bit(keys: np.ndarray) -> np.ndarray:
    return (mix(keys) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def held_by(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the table that the bitmap was made from."""
    at = _bit(keys)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _bit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = np.unique(_bit(joint_key([c.to_numpy().view(np.uint64) for c in batch.columns])))
        yield pa.RecordBatch.from_arrays([pa.array(at // SEGMENT_BITS), pa.array(at)], names=["segment", "bit"])


def _segment(group: pa.Table) -> pa.Table:
    bits = np.zeros(SEGMENT_BITS, bool)
    bits[group["bit"].to_numpy() % SEGMENT_BITS] = True
    packed = np.packbits(bits, bitorder="little").tobytes()
    return pa.table({"segment": group["segment"][:1], "bits": pa.array([packed], pa.binary())})


def bitmap_of(keys: DataFrame) -> np.ndarray:
    """The bitmap of a table's rows, whose columns are longs without NULL: 8 MB, however many they are."""
    bits = keys.mapInArrow(_bit_rows, "segment long, bit long").distinct()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    width = SEGMENT_BITS // 8
    for row in bits.groupBy("segment").applyInArrow(_segment, "segment long, bits binary").collect():
        out[row["segment"] * width : (row["segment"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    return out
