"""Pack tokenized documents into fixed windows, online and in bounded space.

Each task keeps a fixed number of open windows. A document's whole windows are done at once; its
rest goes to the open window it fits best, and where none fits, the fullest is emitted to
make room. What is still open at the end of the tasks is merged, a few tasks' windows at a
time, until none is left.
"""

from __future__ import annotations

import base64
import sys
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.scratch import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 1024
OPEN_WINDOWS = 64
END_ID = 0  # fixed: the id that ends every document
MERGED_AT_ONCE = 32  # tasks or groups whose open windows one merge takes
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, open boolean, part long"
)


def public_vocabulary() -> dict[str, str]:
    """Where the public tokenizer's files lie; executors have them under the same paths."""
    import public_tokenizers

    return {
        "json_path": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


class Encoder:
    """Token ids of the byte-level vocabulary in ``json_path``.

    ``ranks_path`` holds the same vocabulary for the faster of two libraries that give the
    same ids; texts it cannot take (endless white space) go to the other.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        special = {"<|endoftext|>": len(ranks)}
        self.fast = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.json_path = json_path
        self.slow = None

    def ids(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except BaseException as error:  # a panic of the library is no Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.json_path)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


class OpenWindows:
    """At most ``limit`` windows with room left; ``done`` collects what is emitted."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.room: list[tuple[int, int]] = []  # (room left, window), ascending
        self.held: dict[int, list] = {}
        self.done: list[tuple[int, list]] = []

    def place(self, piece: tuple, length: int, number: int) -> None:
        """Put a piece where it fits best, else into the new window ``number``."""
        at = bisect_left(self.room, (length, -1))
        if at < len(self.room):
            left, window = self.room.pop(at)
        else:
            if len(self.room) >= self.limit:
                self._emit(self.room.pop(0)[1])
            left, window = self.size, number
            self.held[window] = []
        self.held[window].append((*piece, self.size - left))
        if left == length:
            self._emit(window)
        else:
            insort(self.room, (left - length, window))

    def _emit(self, window: int) -> None:
        self.done.append((window, self.held.pop(window)))

    def rest(self) -> list[tuple[int, list]]:
        rest = [(window, self.held[window]) for _, window in self.room]
        self.room, self.held = [], {}
        return rest


def _first_number(level: int, part: int) -> int:
    """Sequence numbers of a merge level's task go up from here: 2**34 each, for 2**24 tasks."""
    return (level << 58) + (part << 34)


def _batch(windows: list[tuple[int, list]], open_: bool, part: int) -> pa.RecordBatch:
    rows = [(*piece[:-1], window, piece[-1]) for window, pieces in windows for piece in pieces]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    arrays = [pa.array(column, pa.int64()) for column in columns]
    arrays += [pa.array([open_] * len(rows), pa.bool_()), pa.array([part] * len(rows), pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=[*names, "open", "part"])


def _packer(paths: tuple[str, str, str], window: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*paths)
        part = TaskContext.get().partitionId()
        number = _first_number(0, part)
        bins = OpenWindows(window, limit)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encoder.ids(text.as_py() or ""), END_ID).astype("<u4")
                n = len(ids)
                for start in range(0, n, window):
                    piece = ids[start : start + window]
                    row = (doc_id, start, len(piece), zlib.crc32(piece.tobytes()), n)
                    number += 1
                    bins.place(row, len(piece), number)
                if len(bins.done) > 4096:
                    yield _batch(bins.done, False, part)
                    bins.done = []
        yield _batch(bins.done, False, part)
        yield _batch(bins.rest(), True, part)

    return run


def _merger(window: int, limit: int, level: int, last: bool):
    """Pack the pieces of one group's open windows anew, the longest first."""

    def run(group: pa.Table) -> pa.Table:
        part = group["part"][0].as_py() // MERGED_AT_ONCE
        names = ("length", "sequence_id", "offset", "doc_id", "start", "ids_crc32", "doc_tokens")
        pieces = sorted(
            zip(*(group[name].to_pylist() for name in names), strict=True), key=lambda p: (-p[0], p[1], p[2])
        )
        bins = OpenWindows(window, len(pieces))
        number = _first_number(level, part)
        for length, _, _, doc_id, start, crc, total in pieces:
            number += 1
            bins.place((doc_id, start, length, crc, total), length, number)
        rest = bins.rest()
        closed = bins.done + (rest if last else rest[:-limit])
        still = [] if last else rest[-limit:]
        return pa.Table.from_batches([_batch(closed, False, part), _batch(still, True, part)])

    return run


def packed(
    docs: DataFrame,
    json_path: str,
    ranks_path: str,
    pattern: str,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, a row per piece.

    A document is its text's ids and one id 0; NULL and empty texts are that id alone.
    Pieces of one ``sequence_id`` stand one after the other from ``offset`` 0 and are at most ``window``
    ids together; what is missing is padding. Repeated rows are packed one by one; an
    empty table gives no rows; further columns are ignored.

    Texts are read once and only piece rows are written, so no text is shuffled. A task holds
    ``open_windows`` windows. A merge takes the open windows of 32 tasks or groups, whatever
    the table's size, and leaves as many open as one task does.

    The vocabulary files must lie under the same paths on every executor.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    first = scratch.write(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            _packer((json_path, ranks_path, pattern), window, open_windows), SCHEMA
        ),
        parts=F.max("part") + 1,
    )
    tables, parts = [first], first.counts["parts"]
    while True:
        groups, level = -(-parts // MERGED_AT_ONCE), len(tables)
        merged = (
            tables[-1]
            .df.where("open")
            .groupBy(F.expr(f"part div {MERGED_AT_ONCE}"))
            .applyInArrow(_merger(window, open_windows, level, groups <= 1), SCHEMA)
        )
        tables.append(scratch.write(merged))
        parts = groups
        if groups <= 1:
            break
    return scratch.scan(tables).where("not open").drop("open", "part")
