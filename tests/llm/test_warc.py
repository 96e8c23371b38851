"""Archives: round trips, odd pages, and what the salvage reader recovers from damage."""

import gzip
import hashlib
import re

import numpy as np

from rootwise.llm.warc import archived_and_read, payloads, read_warc, salvage, warc_records, write_warc

ODD = [
    (1, "http://a/", "x" * 100), (2, None, "x" * 100), (3, "http://c/\r\nX: y", "short"), (4, "http://d/", "short"),
    (5, "http://e/", None), (6, "", ""), (7, "http://g/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9),
    (8, "http://h/", "é" * 60), (9, "http://i/", "é" * 60), (None, "http://j/", "x" * 100), (8, "http://h/", "é" * 60),
    (10, "http://k/", "long\r\n\r\n" * 50_000),
]


def odd_pages(spark):
    return spark.createDataFrame(
        [(*row, "clash") for row in ODD], "page_id long, url string, html string, digest string"
    )


def expected(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, page_id), page_id)
    for page_id, _, html in rows:
        data = (html or "").encode()
        earlier = first.get(html)
        revisit = earlier is not None and page_id is not None and page_id > earlier
        yield (
            page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
            earlier if revisit else None,
        )


def test_round_trip(spark):
    got = [tuple(r) for r in archived_and_read(odd_pages(spark)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected(ODD)))
    assert archived_and_read(odd_pages(spark).limit(0)).count() == 0


def test_archives_are_small_files(spark, tmp_path):
    path = str(tmp_path / "warc")
    write_warc(odd_pages(spark).repartition(1), path, archive_bytes=2000)
    records = read_warc(spark, path)
    assert records.select("archive").distinct().count() > 3
    assert records.where("kind = 'gap'").count() == 0
    got = [tuple(r) for r in payloads(records).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected(ODD)))


def some_records(spark, n=12):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"page {i} " * 40) for i in range(n)], "page_id long, url string, html string")
    return [(r["record"] + "\r\n").encode() for r in warc_records(pages).collect()]


def found(data):
    rows = list(salvage(data))
    ids = [row[4]["x-page-id"] for row in rows if row[2] == "record"]
    gaps = [(row[0], row[1]) for row in rows if row[2] == "gap"]
    assert sorted((r[0], r[1]) for r in rows if r[2] == "gap" or True)[0][0] == 0
    return ids, gaps


def test_damage_costs_only_the_damaged(spark):
    records = some_records(spark)
    sizes = np.cumsum([0, *map(len, records)])
    data = bytearray(b"".join(records))
    data[sizes[3] + 300 + records[3][300:].find(b"page")] ^= 1  # a payload byte
    data[sizes[7]] ^= 1  # a version line
    ids, gaps = found(bytes(data))
    order = [r.split(b"X-Page-Id: ")[1].split(b"\r")[0].decode() for r in records]
    assert ids == [x for k, x in enumerate(order) if k not in (3, 7)]
    assert gaps == [(sizes[3], len(records[3])), (sizes[7], len(records[7]))]


def test_members_are_salvaged_too(spark):
    records = some_records(spark)
    order = [r.split(b"X-Page-Id: ")[1].split(b"\r")[0].decode() for r in records]
    members = [gzip.compress(r) for r in records]
    broken = bytearray(members[5])
    broken[len(broken) // 2] ^= 0xFF
    data = b"".join([*members[:5], bytes(broken), b"junk", *members[6:9], records[9], *members[10:]])
    ids, gaps = found(data)
    assert ids == [x for k, x in enumerate(order) if k != 5]
    start = sum(map(len, members[:5]))
    assert gaps == [(start, len(broken) + 4)]


def test_records_inside_a_member_are_salvaged(spark):
    records = some_records(spark, 6)
    order = [r.split(b"X-Page-Id: ")[1].split(b"\r")[0].decode() for r in records]
    sizes = np.cumsum([0, *map(len, records)])
    content = bytearray(b"".join(records))
    content[sizes[2] + 300 + records[2][300:].find(b"page")] ^= 1
    member = gzip.compress(bytes(content))
    rows = list(salvage(member + records[0]))
    assert [r[4]["x-page-id"] for r in rows if r[2] == "record"] == [*order[:2], *order[3:], order[0]]
    assert [(r[0], r[1], r[6]) for r in rows if r[2] == "gap"] == [(0, len(member), (sizes[2], len(records[2])))]
    assert rows[0][6] == (0, sizes[1]) and rows[-1][6] is None and rows[-1][0] == len(member)


def test_a_damaged_member_gives_what_was_unpacked_before(spark):
    records = some_records(spark, 40)
    noise = np.random.default_rng(3).integers(0, 256, 200_000, np.uint8).tobytes()  # so that pieces matter
    order = [r.split(b"X-Page-Id: ")[1].split(b"\r")[0].decode() for r in records]
    member = gzip.compress(b"".join(records) + noise)
    bare = b"".join(re.sub(b"WARC-Block-Digest: .*\r\n", b"", r) for r in records)
    wrong_sum = member[:-8] + bytes(4) + member[-4:]
    for data in (member[: len(member) - 60_000], wrong_sum):
        rows = list(salvage(data + b"\n" + records[0]))
        assert [r[4]["x-page-id"] for r in rows if r[2] == "record"] == [*order, order[0]]
        assert [(r[0], r[1]) for r in rows if r[2] == "gap"] == [(0, len(data) + 1)]
        # blocks without a digest are not taken from a member that failed
        rows = list(salvage(gzip.compress(bare + noise)[:-9]))
        assert [r[2] for r in rows] == ["gap"]


def test_inner_places_are_columns(spark, tmp_path):
    records = some_records(spark, 3)
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(b"".join([records[0], b"junk\r\n", records[1]])) + records[2])
    rows = read_warc(spark, str(tmp_path)).orderBy("offset", "inner_offset").collect()
    assert [r["kind"] for r in rows] == ["response", "gap", "response", "response"]
    n = len(records[0])
    assert [r["inner_offset"] for r in rows] == [0, n, n + 6, None]
    assert [r["inner_size"] for r in rows] == [n, 6, len(records[1]), None]


def test_cut_files_and_junk(spark):
    records = some_records(spark, 3)
    data = b"".join(records)
    assert found(data[:-1])[0] == found(data)[0][:2]
    assert found(data[:-1])[1] == [(len(records[0]) + len(records[1]), len(records[2]) - 1)]
    assert list(salvage(b"")) == []
    assert found(b"\x00" * 50)[1] == [(0, 50)]
    wrong = data.replace(b"Content-Length: ", b"Content-Length: 9", 1)
    assert len(found(wrong)[0]) == 2
