"""Blocks of bounded size: runs of depths whose formulas one task can resolve by itself.

Depths that follow one another are put into a window while their texts fit :data:`BLOCK_BYTES`; a depth that is
larger by itself is a window of several blocks, whose formulas do not need each other. Two windows side by side
are larger than a block, so there are at most ``2 * size / BLOCK_BYTES + 1`` of them, and never more than depths.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rootwise.functions.arith import evaluate_batch
from rootwise.functions.text import INT_MAX, INT_MIN, OPENING, REFERENCE

# Executors get this module along with the function: they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Text of the pieces that one task resolves.
BLOCK_BYTES = 8 << 20
# What a piece takes besides its text.
PIECE_BYTES = 64

# Values of ``status``.
OK = "ok"
BLOCKED = "blocked"
PARSE_ERROR = "parse_error"


def piece_bytes() -> Column:
    """Size of a piece ``(lead, ref, tail)``."""
    texts = [F.coalesce(F.octet_length(name), F.lit(0)) for name in ("lead", "ref", "tail")]
    return sum(texts, F.lit(PIECE_BYTES)).cast("long")


def depth_windows(sizes: DataFrame, block_bytes: int) -> DataFrame:
    """``(depth, window, parts)`` from ``(depth, bytes)``: windows count from 1 in order of depth.

    ``parts`` is the number of blocks in the window, 1 where it may hold several depths. There is one row a
    depth, whatever the number of formulas.
    """
    so_far = Window.orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    large = F.col("bytes") > block_bytes
    small_bytes = F.when(large, 0).otherwise(F.col("bytes"))
    filled = sizes.withColumn("large", large).select(
        "depth",
        "large",
        F.when(large, F.ceil(F.col("bytes") / block_bytes)).otherwise(1).cast("int").alias("parts"),
        # A large depth ends a window, and what was filled up to the row before says which one a small depth is in.
        F.sum(large.cast("int")).over(so_far).alias("larger"),
        F.floor((F.sum(small_bytes).over(so_far) - small_bytes) / block_bytes).alias("full"),
    )
    place = F.dense_rank().over(Window.orderBy("larger", ~F.col("large"), "full"))
    return filled.select("depth", place.cast("int").alias("window"), "parts")


def _argument(value: float) -> str | None:
    """Text of a value that is handed on, as ``int_text`` writes it; None for what is not."""
    if value == float("inf"):
        return None
    if value != value:
        return "0"
    return str(INT_MAX if value >= INT_MAX else INT_MIN if value <= INT_MIN else int(value))


def block_resolver(root_id: str, on_error: str, schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    """From a block's pieces to ``(id, formula, depth, value, status)`` of its formulas, depth by depth.

    A piece has ``(id, pos, lead, ref, tail, argument, depth, inner)``; the argument of an ``inner`` one is
    a formula of the same block, of a smaller depth.
    """

    def resolve(block: pa.Table) -> pa.Table:
        block = block.sort_by([("depth", "ascending"), ("id", "ascending"), ("pos", "ascending")])
        depths = block["depth"].to_numpy()
        starts = np.flatnonzero(np.diff(depths, prepend=depths[:1] - 1)).tolist()
        columns = [block[name].to_pylist() for name in ("id", "lead", "ref", "tail", "argument", "inner")]
        sent: dict[str, str | None] = {}
        done: dict[str, list] = {name: [] for name in schema.names}
        for start, end in zip(starts, [*starts[1:], len(depths)], strict=True):
            texts: dict[object, list[str]] = {}
            for i, lead, ref, tail, argument, inner in zip(*(column[start:end] for column in columns), strict=True):
                given = sent.get(ref) if inner else argument
                if given is None:
                    given = "" if ref is None else f"{OPENING}{ref})"
                texts.setdefault(i, []).append(lead + given + tail)
            ids, filled = list(texts), ["".join(parts) for parts in texts.values()]
            ready = [None if i == root_id or REFERENCE in text else text for i, text in zip(ids, filled, strict=True)]
            values, valid = evaluate_batch(pa.array(ready, pa.string()))
            if on_error == "fail":
                bad = [text for text, known in zip(ready, valid, strict=True) if text is not None and not known]
                if bad:
                    raise ValueError(f"not an arithmetic expression: {bad[0]!r}")
            numbers = [value if known else None for value, known in zip(values.tolist(), valid.tolist(), strict=True)]
            numbers = [0.0 if i == root_id else number for i, number in zip(ids, numbers, strict=True)]
            sent.update((str(i), _argument(number)) for i, number in zip(ids, numbers, strict=True) if number is not None)
            done["id"] += ids
            done["formula"] += filled
            done["depth"] += [int(depths[start])] * len(ids)
            done["value"] += numbers
            done["status"] += [
                OK if number is not None else BLOCKED if REFERENCE in text else PARSE_ERROR
                for text, number in zip(filled, numbers, strict=True)
            ]
        return pa.Table.from_pydict(done, schema=schema)

    return resolve
