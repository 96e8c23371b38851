"""Line dedup by range-partitioned line hashes, given back as keep bitmaps.

Every distinct line of a document is one row: the 128-bit hash of its key, the document, and the places where
it stands. Rows are partitioned by range over hash and document and sorted so, and each task streams
through them: a hash's documents follow one another, first occurrence first, and no more rows of a hash
are held than decide it. A hash that many documents share lies in several tasks; what is undecided
at a task's edges, fewer rows than the limit, is added up between the tasks.

The result is not text: per document a compressed bitmap of the lines that stay.
"""

from __future__ import annotations

import hashlib
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootwise.scratch import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_DOCS = 10
MIN_CHARS = 1
BLANKS = b" \t\n\x0b\x0c\r"
BATCH_ROWS = 50_000
ROW = "high long, low long, doc_id long, text_hash long, n_lines int, places binary"
DROPPED, OPEN, LEAD = "dropped", "open", "lead"


def line_key(line: bytes) -> bytes:
    """What makes two lines the same: no blanks around them, ``A-Z`` as ``a-z``."""
    return line.strip(BLANKS).lower()


def _line_rows(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            ids, names = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            for doc_id, name, text in zip(ids, names, texts, strict=True):
                lines = (text.as_py() or b"").split(b"\n")
                places: dict[bytes, list[int]] = {}
                for at, line in enumerate(lines):
                    key = line_key(line)
                    if len(key) >= min_chars and (min_chars < 2 or len(key.decode()) >= min_chars):
                        places.setdefault(key, []).append(at)
                for key, at in places.items():
                    digest = hashlib.blake2b(key, digest_size=16).digest()
                    high, low = np.frombuffer(digest, "<i8").tolist()
                    out.append((high, low, doc_id, name, len(lines), np.array(at, "<u4").tobytes()))
                if len(out) >= BATCH_ROWS:
                    yield _as_batch(out)
                    out = []
        if out:
            yield _as_batch(out)

    return run


def _as_batch(rows: list[tuple], *more: tuple[str, pa.DataType]) -> pa.RecordBatch:
    kinds = [
        ("high", pa.int64()), ("low", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()),
        ("n_lines", pa.int32()), ("places", pa.binary()), *more,
    ]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, (_, kind) in zip(columns, kinds, strict=True)], names=[name for name, _ in kinds]
    )


def _streamed(min_docs: int, keep_first: bool):
    """A task's function over rows sorted by hash and document: those of lines that go.

    Of a task's first and last hash, which other tasks may hold too, rows are ``open`` where fewer than
    ``min_docs`` documents are seen here; else the first of them is the ``lead``, which tells the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now: tuple | None = None
        document: tuple | None = None
        held: list[tuple] = []  # the first row, and others until there are enough
        many = edge = False

        def end(last: bool) -> None:
            if edge or last:
                out.extend((*row, LEAD if many else OPEN) for row in held)
            elif many:
                first = held[0]
                out.append((*first[:-1], first[-1][4:] if keep_first else first[-1], DROPPED))

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if row[:2] != now:
                    if now is not None:
                        end(last=False)
                    edge, now, document, held, many = now is None, row[:2], None, [], False
                if row[:4] == document:
                    continue  # a row of documents that is there twice
                document = row[:4]
                if many:
                    out.append((*row, DROPPED))
                    continue
                held.append(row)
                if len(held) >= min_docs:
                    out.extend((*r, DROPPED) for r in held[1:])
                    many, held = True, held[:1]
            if len(out) >= BATCH_ROWS:
                yield _as_batch(out, ("state", pa.string()))
                out = []
        if now is not None:
            end(last=True)
        if out:
            yield _as_batch(out, ("state", pa.string()))

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a document from its rows of places, which follow one another."""
    out: list[tuple] = []
    now, keep = None, np.empty(0, bool)

    def done() -> None:
        out.append((*now, int(len(keep) - keep.sum()), zlib.compress(np.packbits(keep).tobytes(), 1)))

    def as_batch() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n_dropped", "keep"])

    for batch in batches:
        for *document, n_lines, places in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if document != now:
                if now is not None:
                    done()
                now, keep = document, np.ones(n_lines, bool)
            keep[np.frombuffer(places, "<u4")] = False
        if len(out) >= BATCH_ROWS:
            yield as_batch()
            out = []
    if now is not None:
        done()
    if out:
        yield as_batch()


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def keep_bitmaps(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False
) -> DataFrame:
    """``(doc_id, text_hash, n_dropped, keep)`` of every document of ``docs`` that loses a line.

    Lines are what ``\\n`` separates; two are the same where :func:`line_key` is. A line of at least
    ``min_chars`` code points that stands in at least ``min_docs`` documents goes from all of them, each time
    it stands there; with ``keep_first`` its first place in the document with the smallest id stays. ``keep``
    has a bit per line, 1 for those that stay, packed and compressed by zlib; ``text_hash`` is the
    ``xxhash64`` of the text. A document is an id with a text: rows that repeat both are one, one id on two
    texts is two, and NULL is an id too, the smallest. NULL and empty texts are one empty line, which is
    shorter than any limit from 1 on; an empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("text_hash"), "text")
    rows = rows.mapInArrow(_line_rows(min_chars), ROW)
    order = ["high", "low", "doc_id", "text_hash"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = scratch.write(
        sorted_rows.mapInArrow(_streamed(min_docs, keep_first), ROW + ", state string"),
        undecided=F.count_if(F.col("state") != DROPPED),
    )
    dropped = found.df.where(F.col("state") == DROPPED)
    if found.counts["undecided"]:
        # At most two hashes a task, each with fewer rows than min_docs.
        undecided = found.df.where(F.col("state") != DROPPED)
        place = F.struct(F.col("doc_id").isNotNull(), "doc_id", "text_hash")
        seen = undecided.groupBy("high", "low").agg(
            F.count(F.lit(1)).alias("n"), F.max(F.col("state") == LEAD).alias("many"), F.min(place).alias("first")
        )
        enough = seen.where(F.col("many") | (F.col("n") >= min_docs)).select("high", "low", "first")
        more = undecided.join(enough, ["high", "low"])
        if keep_first:
            rest = F.when(place == F.col("first"), F.expr("substring(places, 5)")).otherwise(F.col("places"))
            more = more.withColumn("places", rest)
        dropped = dropped.unionByName(more.select(*found.df.columns))
    document = ["doc_id", "text_hash"]
    by_document = dropped.where("length(places) > 0").select(*document, "n_lines", "places")
    by_document = by_document.repartition(*document).sortWithinPartitions(*document)
    return by_document.mapInArrow(_bitmaps, "doc_id long, text_hash long, n_dropped long, keep binary")


def with_kept_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``, by the bitmaps of :func:`keep_bitmaps`.

    Columns of these names are replaced. Every row of ``docs`` comes once; a document without a
    bitmap keeps all its lines, and NULL gives an empty text.
    """
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("whole")
    rows = docs.select(whole, F.col("doc_id").cast("long").alias("id"), _text_hash().alias("hash"), "text")
    marks = bitmaps.select(F.col("doc_id").alias("mark_id"), F.col("text_hash").alias("mark_hash"), "keep")
    joined = rows.join(marks, F.col("id").eqNullSafe(F.col("mark_id")) & (F.col("hash") == F.col("mark_hash")), "left")
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    kept = joined.select("whole", lines.alias("lines"), _kept_lines()("text", "keep").alias("kept"))
    own = [F.col(f"whole.`{name}`") for name in docs.columns if name not in ("kept_text", "n_lines", "n_dropped")]
    return kept.select(
        *own,
        F.col("kept.text").alias("kept_text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.col("kept.dropped").alias("n_dropped"),
    )


def _kept_lines():
    @F.arrow_udf("text string, dropped long")
    def kept(texts: pa.Array, keeps: pa.Array) -> pa.Array:
        out, dropped = [], []
        for text, keep in zip(texts, keeps, strict=True):
            text = text.as_py() or ""
            if keep.is_valid:
                lines = text.split("\n")
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep.as_py()), np.uint8), count=len(lines))
                text = "\n".join(line for line, stays in zip(lines, bits.tolist(), strict=True) if stays)
                dropped.append(int(len(bits) - bits.sum()))
            else:
                dropped.append(0)
            out.append(text)
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(dropped, pa.int64())], names=["text", "dropped"])

    return kept


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256)``, one row per row of ``docs``.

    What goes is what :func:`keep_bitmaps` says; the digest is of the lines that stay, joined by ``\\n``.
    """
    kept = with_kept_lines(docs.select("doc_id", "text"), keep_bitmaps(docs, min_docs, min_chars))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
