"""WARC archives: written by Spark's text writer, read back by a salvage reader.

Records are plain text, so a file is a run of records that Spark's writer commits like any other
output. The reader takes any bytes: plain records or gzip members. Where a check
fails it looks for the next member or version line that begins a sound record, goes on
from there, and logs the bytes in between.
"""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rootwise.scratch import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REVISIT_FROM = 100  # bytes; equal payloads of at least this many are written once
ARCHIVE_BYTES = 32 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed by the format
CRLF = "\r\n"
SCHEMA = (
    "archive string, offset long, size long, kind string, reason string, record_id string, "
    "refers_to_id string, uri string, page_id long, payload_bytes long, payload_digest string, "
    "inner_offset long, inner_size long"
)
PIECE = 1 << 16  # bytes of a member that are unpacked at a time
VERSION = re.compile(rb"(?<![^\n])WARC/1\.[01]\r\n")
START = re.compile(rb"\x1f\x8b\x08|(?<![^\n])WARC/1\.[01]\r\n")


# -- writing ---------------------------------------------------------------------------


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _record_id(page_id: Column, digest: Column) -> Column:
    code = F.md5(F.concat_ws(" ", page_id.cast("string"), digest).cast("binary"))
    parts = [F.substring(code, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def warc_records(pages: DataFrame) -> DataFrame:
    """``(record)``: one WARC record as text per row of ``pages``, without its last line end.

    Of equal payloads of at least 100 bytes the smallest ``page_id`` is a response, and greater ids
    revisit it; a row without an id, or that repeats the smallest one, is a response itself. NULL
    html is an empty payload, a NULL url has no line, and line ends in a url are left out.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace("url", r"[\r\n]", "").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).alias("size"),
        F.sha2(payload, 256).alias("digest"),
    )
    shared = (
        rows.where(F.col("size") >= REVISIT_FROM)
        .groupBy(F.col("digest").alias("same"))
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    # Written first, so that the planner knows its size: payloads are shuffled only if it is large.
    firsts = Scratch(pages.sparkSession, "payloads").write(shared).df
    rows = rows.join(firsts, (F.col("digest") == F.col("same")) & (F.col("page_id") > F.col("first")), "left")
    revisit = F.col("first").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("size").cast("string"),
        F.lit(CRLF + CRLF),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    rows = rows.withColumn("block", block)
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(CRLF),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        F.lit(f"WARC-Date: {DATE}{CRLF}"),
        _line("WARC-Target-URI", F.col("url")),
        _line("X-Page-Id", F.col("page_id").cast("string")),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("first"), F.col("digest")))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2("block", 256))),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(CRLF + CRLF),
        F.col("block"),
        F.lit(CRLF),
    )
    return rows.select(record.alias("record"))


def _archiver(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def archive():
            text = pa.array([CRLF.encode().join(held)], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([text], names=["value"])

        for batch in batches:
            for record in batch.column(0).cast(pa.binary()):
                record = record.as_py()
                if held and size + len(record) > most:
                    yield archive()
                    held, size = [], 0
                held.append(record)
                size += len(record)
        if held:
            yield archive()

    return run


def write_warc(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write :func:`warc_records` to files of at most ``archive_bytes``, or of one larger record.

    ``path`` may be on any store Spark writes to; tasks that run twice leave no double.
    """
    archives = warc_records(pages).mapInArrow(_archiver(archive_bytes), "value string")
    archives.write.option("lineSep", CRLF).option("maxRecordsPerFile", 1).text(path)


# -- reading ---------------------------------------------------------------------------


def _parsed(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``; ValueError if a check fails."""
    end = data.find(b"\r\n\r\n", at)
    if not data.startswith(b"WARC/1.", at) or end < 0:
        raise ValueError("no record")
    lines = data[at:end].decode("utf-8", "replace").split(CRLF)[1:]
    headers = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError("bad header line")
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not re.fullmatch("[0-9]+", length):
        raise ValueError("no length")
    block = data[end + 4 : end + 4 + int(length)]
    stop = end + 4 + int(length)
    if len(block) < int(length) or data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("length does not fit")
    kind, _, digest = headers.get("warc-block-digest", "").partition(":")
    if kind == "sha256" and hashlib.sha256(block).hexdigest() != digest:
        raise ValueError("block digest differs")
    return headers, block, stop + 4


def _member(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """Content, end and fault of the gzip member at ``at``; of a faulty one, all that can be unpacked before the fault."""
    unpack, parts, place = zlib.decompressobj(31), [], at
    size = PIECE
    while not unpack.eof and place < len(data):
        before = unpack.copy()
        try:
            parts.append(unpack.decompress(data[place : place + size]))
        except zlib.error:
            if size == 1:
                return b"".join(parts), place, "bad member"
            unpack, size = before, 1  # byte by byte up to the fault
            continue
        place += size
    return b"".join(parts), min(place, len(data)) - len(unpack.unused_data), None if unpack.eof else "member is cut off"


def _inside(content: bytes, digest_needed: bool) -> Iterator[tuple]:
    """``(offset, size, reason, headers, block)`` of all records and gaps of a member's content."""
    at, gap, reason = 0, None, ""
    while at < len(content):
        try:
            headers, block, end = _parsed(content, at)
            if digest_needed and not headers.get("warc-block-digest", "").startswith("sha256:"):
                raise ValueError("nothing vouches for the block")
        except ValueError as error:
            if gap is None:
                gap, reason = at, str(error)
            following = VERSION.search(content, at + 1)
            at = following.start() if following else len(content)
            continue
        if gap is not None:
            yield gap, at - gap, reason, None, None
            gap = None
        yield at, end - at, None, headers, block
        at = end
    if gap is not None:
        yield gap, len(content) - gap, reason, None, None


def salvage(data: bytes) -> Iterator[tuple]:
    """``(offset, size, "record", None, headers, block, inner)`` of every sound record and
    ``(offset, size, "gap", reason, None, None, inner)`` of every stretch that holds none.

    Outside gzip members ``inner`` is None. Inside one, offset and size are the member's, and ``inner`` is the
    place and size within its content. Of a member that fails its check or is cut off, the whole is a gap up to the next
    start; records unpacked before the fault are there as well if their block digests fit.
    """
    at, gap, reason = 0, None, ""
    while at < len(data):
        fault, found = None, []
        if data.startswith(b"\x1f\x8b", at):
            content, end, fault = _member(data, at)
            if fault is not None:  # it may have run on into what follows, which is read by itself
                following = START.search(data, at + 1)
                content, _, _ = _member(data[: following.start()] if following else data, at)
            found = list(_inside(content, fault is not None))
        else:
            try:
                headers, block, end = _parsed(data, at)
                found = [(None, None, None, headers, block)]
            except ValueError as error:
                fault = str(error)
        if fault is not None:
            following = START.search(data, at + 1)
            end = following.start() if following else len(data)
            if gap is None:
                gap, reason = at, fault
        elif gap is not None:
            yield gap, at - gap, "gap", reason, None, None, None
            gap = None
        for place, size, why, headers, block in found:
            inner = None if place is None else (place, size)
            if headers is not None:
                yield at, end - at, "record", None, headers, block, inner
            elif fault is None:
                yield at, end - at, "gap", why, None, None, inner
        at = end
    if gap is not None:
        yield gap, len(data) - gap, "gap", reason, None, None, None


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch("-?[0-9]+", text) else None


def _row(archive: str, offset: int, size: int, kind: str, reason: str | None, headers, block, inner) -> tuple:
    inner = inner or (None, None)
    if headers is None:
        return archive, offset, size, kind, reason, None, None, None, None, None, None, *inner
    http, _, payload = block.partition(b"\r\n\r\n")
    what = headers.get("warc-type")
    if what == "response":
        length, digest = len(payload), hashlib.sha256(payload).hexdigest()
        if headers.get("warc-payload-digest", f"sha256:{digest}") != f"sha256:{digest}":
            return archive, offset, size, "gap", "payload digest differs", None, None, None, None, None, None, *inner
    else:  # the payload is in the record referred to
        stated = re.search(rb"(?i)^content-length: *([0-9]+)", http, re.MULTILINE)
        length = int(stated[1]) if stated else None
        digest = headers.get("warc-payload-digest", "").removeprefix("sha256:") or None
    return (
        archive, offset, size, what, None, headers.get("warc-record-id"), headers.get("warc-refers-to"),
        headers.get("warc-target-uri"), _number(headers.get("x-page-id")), length, digest, *inner,
    )


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    kinds = [pa.int64() if field.endswith("long") else pa.string() for field in SCHEMA.split(", ")]
    for batch in batches:
        for archive, content in zip(batch.column(0), batch.column(1), strict=True):
            rows = [_row(archive.as_py(), *found) for found in salvage(content.as_py() or b"")]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names=names
            )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record and every gap of the archives under ``path``.

    ``kind`` is the record's type, or ``gap`` for quarantined bytes, with their ``reason``; ``offset`` and
    ``size`` say where in ``archive``; of what lies inside a gzip member they are the member's, and ``inner_offset`` and
    ``inner_size`` say where in its content. A response's length and digest are those of the payload as
    read; a revisit's are those its record states. One archive is in memory per task.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_reader, SCHEMA)


def payloads(records: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` per response or revisit.

    A revisit gets the ``page_id`` of the response it refers to, found by record id; NULL if that was lost.
    """
    responses = (
        records.where("kind = 'response'")
        .groupBy(F.col("record_id").alias("response_id"))
        .agg(F.min("page_id").alias("refers_to"))
    )
    revisits = records.where("kind = 'revisit'").join(
        responses, F.col("refers_to_id") == F.col("response_id"), "left"
    )
    columns = ["page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type")]
    return (
        records.where("kind = 'response'")
        .select(*columns, F.lit(None).cast("long").alias("refers_to"))
        .unionByName(revisits.select(*columns, "refers_to"))
    )


def archived_and_read(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder, read them back, and list their payloads.

    One row per row of ``pages``; see :func:`warc_records` for NULLs and repeated rows. An
    empty table gives no rows. Pages are read twice, once for digests; only digests and ids are
    grouped, so a payload that a third of all pages share is one row per task.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    path = f"{scratch.path}/archives"
    write_warc(pages, path)
    records = scratch.write(read_warc(pages.sparkSession, path)).df
    return payloads(records)
