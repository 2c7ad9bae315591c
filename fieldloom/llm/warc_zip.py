"""WARC records in ZIP packages: written, and read back by ranges.

A package is a ZIP file of stored (uncompressed) members: ``archive/data.warc.gz``,
one gzip member per record, and ``indexes/index.cdxj``, one line per record with its
offset and length.  Sizes and offsets stand in ZIP64 fields, so packages may pass
4 GB.  The reader asks for byte ranges only: end record (and its ZIP64 locator and
directory end), central directory, the local header of a member, the index, then
single records.  Nothing is unpacked as a whole.

Equal payloads: the record with the smallest page_id is the response, the others
revisit it.  Payloads below ``min_bytes`` are responses all.

Packages hold ``package_bytes`` of records at most (a larger record gets one of its
own) and are files of their own in the folder given.  Spark's text writer puts
them there: one row per package, its line end being the ZIP comment, so they
are committed like any other output and survive lost executors.

Defined results: null html is an empty payload; a null url is empty; rows that repeat
the smallest page_id are responses each; rows without page_id revisit the smallest
id of their payload, or are responses if there is none; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.shared import fits, materialize, shared_folder

from .common import map_rows

PACKAGE_BYTES = 16 << 20
BROADCAST_ROWS = 100_000
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
COMMENT = b"\n"
#: fixed values of the ZIP format: signatures, the mark for "see ZIP64"
LOCAL, CENTRAL, END, END64, LOCATOR = (b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07")
BIG = 0xFFFFFFFF
ZIP64 = 45  # version needed
DOS_DATE = 0x21  # 1980-01-01


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# writing -------------------------------------------------------------------

def roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, refers_to (null: a response)."""
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    keyed = rows.withColumn("key", F.sha1("payload"))
    firsts = (keyed.filter(F.octet_length("payload") >= min_bytes).groupBy("key")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .filter((F.col("n") > 1) & F.col("first_id").isNotNull()).drop("n"))
    firsts = materialize(firsts, "repeated-payloads")
    joined = keyed.join(F.broadcast(firsts) if fits(firsts, BROADCAST_ROWS) else firsts, "key", "left")
    return joined.select("page_id", "url", "payload", F.when(
        ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record, gzipped by itself."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
            f"WARC-Target-URI: {target}", "WARC-Date: 1970-01-01T00:00:00Z",
            "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest(payload)}", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 1, mtime=0)


def package(records: list[bytes], names: list[str]) -> bytes:
    """A ZIP file with the records and their index."""
    lines, at = [], 0
    for name, r in zip(names, records):
        lines.append(f"{name} {json.dumps({'offset': at, 'length': len(r), 'filename': DATA})}\n")
        at += len(r)
    out, central = bytearray(), bytearray()
    for name, data in ((DATA, b"".join(records)), (INDEX, "".join(lines).encode())):
        sizes = struct.pack("<HHQQ", 1, 16, len(data), len(data))
        places = struct.pack("<HHQQQ", 1, 24, len(data), len(data), len(out))
        shared = struct.pack("<HHHHIIIH", 0x800, 0, 0, DOS_DATE, zlib.crc32(data), BIG, BIG, len(name))
        central += (CENTRAL + struct.pack("<HH", ZIP64, ZIP64) + shared
                    + struct.pack("<HHHHII", len(places), 0, 0, 0, 0, BIG) + name.encode() + places)
        out += LOCAL + struct.pack("<H", ZIP64) + shared + struct.pack("<H", len(sizes)) + name.encode() + sizes + data
    start = len(out)
    out += central
    out += END64 + struct.pack("<QHHIIQQQQ", 44, ZIP64, ZIP64, 0, 0, 2, 2, len(central), start)
    out += LOCATOR + struct.pack("<IQI", 0, start + len(central), 1)
    out += END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, BIG, BIG, len(COMMENT))
    return bytes(out)  # the comment itself is the line end the writer adds


def write_packages(rows: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> None:
    """Writes ``rows`` (of ``roles``) as packages below ``folder``."""
    def run(batches):
        records, names, size = [], [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to")]
            for i in range(batch.num_rows):
                page_id, url, payload, refers_to = (c[i].as_py() for c in columns)
                made = record(page_id, url, payload, refers_to)
                if records and size + len(made) > package_bytes:
                    yield pa.RecordBatch.from_pydict({"value": [package(records, names)]})
                    records, names, size = [], [], 0
                records.append(made)
                names.append("none" if page_id is None else str(page_id))
                size += len(made)
        if records:
            yield pa.RecordBatch.from_pydict({"value": [package(records, names)]})

    (rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("maxRecordsPerFile", 1).option("lineSep", COMMENT.decode()).text(folder))


# reading -------------------------------------------------------------------

Ranges = Callable[[int, int], bytes]  # offset, length -> bytes


def directory(read: Ranges, size: int) -> dict[str, tuple[int, int]]:
    """Offset and length of the bytes of every stored member."""
    tail_at = max(0, size - (22 + 0xFFFF))
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and (at + 22 > len(tail)
                       or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)  # the mark may stand in the comment too
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if count == 0xFFFF or length == BIG or start == BIG:
        mark, _, end64, _ = struct.unpack("<4sIQI", read(tail_at + at - 20, 20))
        if mark != LOCATOR:
            raise ValueError("no ZIP64 locator")
        fields = struct.unpack("<4sQHHIIQQQQ", read(end64, 56))
        if fields[0] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = fields[7:]
    raw, at, found = read(start, length), 0, {}
    for _ in range(count):
        (mark, _, _, _, method, _, _, _, packed, plain, n_name, n_extra, n_comment, _, _, _,
         offset) = struct.unpack_from("<4sHHHHHHIIIHHHHHII", raw, at)
        if mark != CENTRAL:
            raise ValueError("broken central directory")
        name = raw[at + 46:at + 46 + n_name].decode()
        extra = raw[at + 46 + n_name:at + 46 + n_name + n_extra]
        while len(extra) >= 4:  # ZIP64 holds only what does not fit, in this order
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4:4 + n // 8 * 8]))
                plain = next(wide) if plain == BIG else plain
                packed = next(wide) if packed == BIG else packed
                offset = next(wide) if offset == BIG else offset
            extra = extra[4 + n:]
        if method == 0:
            head = read(offset, 30)
            if head[:4] != LOCAL:
                raise ValueError("broken local header")
            found[name] = (offset + 30 + sum(struct.unpack_from("<HH", head, 26)), plain)
        at += 46 + n_name + n_extra + n_comment
    return found


def headers(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.lower(): v.strip() for k, _, v in pairs}, rest


def read_records(read: Ranges, size: int) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """WARC headers, HTTP headers and body of every record the index names."""
    members = directory(read, size)
    for line in read(*members[INDEX]).decode().splitlines():
        entry = json.loads(line.partition(" ")[2])
        start, length = members[entry["filename"]]
        if entry["offset"] + entry["length"] > length:
            raise ValueError("the index points behind its member")
        warc, rest = headers(gzip.decompress(read(start + entry["offset"], entry["length"])))
        http, body = headers(rest[:int(warc["content-length"])])
        yield warc, http, body


def page_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return None if number in ("", "none") else int(number)


def read_packages(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of all records.
    A response's figures come from its payload, a revisit's from its headers."""
    def run(cols: dict) -> dict:
        out = {k: [] for k in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")}
        for content in cols["content"]:
            view = memoryview(content.as_buffer())
            for warc, http, body in read_records(lambda a, n: bytes(view[a:a + n]), len(view)):
                kind, stated = warc["warc-type"], warc["warc-payload-digest"].partition(":")[2]
                if kind == "response" and digest(body) != stated:
                    raise ValueError(f"damaged payload: {warc['warc-record-id']}")
                out["page_id"].append(page_of(warc["warc-record-id"]))
                out["payload_bytes"].append(len(body) if kind == "response" else int(http["content-length"]))
                out["payload_digest"].append(stated)
                out["record_type"].append(kind)
                out["refers_to"].append(page_of(warc.get("warc-refers-to")))
        return out

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return map_rows(files.select("content"), run, "page_id long, payload_bytes long, payload_digest string, "
                                                  "record_type string, refers_to long")


def archived(pages: DataFrame, min_bytes: int = 0, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes ``pages`` as packages into the shared folder and reads them back."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "packages")
    write_packages(roles(pages, min_bytes), folder, package_bytes)
    return read_packages(spark, folder)
