"""WARC packages: read by our reader, by zipfile, and against plain Python."""

import base64
import hashlib
import io
import zipfile
from collections import defaultdict

import pytest

from fieldloom.llm import warc_zip
from fieldloom.llm.common import table
from fieldloom.llm.registry import QUERIES


def expected(rows, min_bytes=0):
    payloads = [(i, (h or "").encode()) for i, h in rows]
    ids = defaultdict(list)
    for i, p in payloads:
        if i is not None:
            ids[p].append(i)
    out = []
    for i, p in payloads:
        first = min(ids[p], default=None) if len(p) >= min_bytes else None
        repeat = first is not None and first != i
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                    "revisit" if repeat else "response", first if repeat else None))
    return sorted(out, key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.page_id, r.html) for r in table(spark, sf, "pages").collect()]
    got = sorted(map(tuple, QUERIES["op8_warc_zip"](spark, sf).collect()), key=str)
    assert got == expected(rows)


@pytest.mark.parametrize("min_bytes,size,joined", [(0, 1 << 24, False), (4, 600, False), (0, 1 << 24, True)])
def test_edges(spark, monkeypatch, min_bytes, size, joined):
    if joined:
        monkeypatch.setattr(warc_zip, "BROADCAST_ROWS", 0)
    rows = [(5, "same"), (3, "same"), (9, "same"), (1, None), (2, ""), (4, "é\r\n\r\nWARC/1.1\r\n"), (6, "x" * 3_000_000),
            (None, "same"), (None, "lonely"), (7, "same"), (8, "abc"), (10, "abc"), (3, "same")]
    rows += [(100 + i, f"page {i}") for i in range(40)]
    df = spark.createDataFrame([(i, None if i == 2 else f"http://a/{i}\r\nX: y", h) for i, h in rows],
                               "page_id long, url string, html string").selectExpr("*", "1 AS payload", "2 AS key")
    got = sorted(map(tuple, warc_zip.archived(df, min_bytes, size).collect()), key=str)
    assert got == expected(rows, min_bytes)
    assert warc_zip.archived(df.limit(0)).count() == 0


def test_packages_are_zip_files(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://a/{i}", f"page {i}" * 50) for i in range(200)],
                               "page_id long, url string, html string")
    warc_zip.write_packages(warc_zip.roles(df), str(tmp_path / "out"), 2_000)
    files = sorted((tmp_path / "out").glob("part-*"))
    assert len(files) > 8
    seen = 0
    for f in files:
        with zipfile.ZipFile(f) as z:
            assert z.testzip() is None
            assert z.namelist() == [warc_zip.DATA, warc_zip.INDEX]
            seen += len(z.read(warc_zip.INDEX).splitlines())
    assert seen == 200


@pytest.mark.parametrize("comment", [b"", b"a comment with PK\x05\x06 inside"])
def test_directory_of_plain_zip_files(comment):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("one", b"first" * 10)
        z.writestr("two/three", b"")
        z.writestr(zipfile.ZipInfo("packed"), b"x" * 1000, zipfile.ZIP_DEFLATED)
        z.comment = comment
    data = b"".join([raw.getvalue()])
    asked = []

    def read(at, n):
        asked.append(n)
        return data[at:at + n]

    members = warc_zip.directory(read, len(data))
    assert set(members) == {"one", "two/three"}  # packed members hold no ranges
    at, n = members["one"]
    assert data[at:at + n] == b"first" * 10


def test_only_ranges_are_read():
    records = [warc_zip.record(i, "http://a", bytes([i % 250]) * 5000, None) for i in range(500)]
    data = warc_zip.package(records, [str(i) for i in range(500)]) + warc_zip.COMMENT
    most = 0

    def read(at, n):
        nonlocal most
        most = max(most, n)
        return data[at:at + n]

    got = [warc_zip.page_of(w["warc-record-id"]) for w, _, _ in warc_zip.read_records(read, len(data))]
    assert got == list(range(500))
    assert most < len(data)
    with pytest.raises(ValueError):
        warc_zip.directory(lambda a, n: b"no zip"[a:a + n], 6)
