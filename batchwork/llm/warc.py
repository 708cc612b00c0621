"""WARC archives: a writer with revisit records and a splittable reader.

Each record is one gzip member, so an archive can be entered at any member.  The reader
cuts every file into byte ranges; a task looks for the gzip magic in its range, decodes the
start of each candidate and accepts it only if a WARC version line comes out (the magic can
occur inside compressed data) and the whole member ends with a good checksum right before
another member or the end of the file.  A record belongs to the range that holds its first
byte; the task reads on past the end of its range to finish it.

Defined results: a null payload is written as an empty one; a null id is written as
``null`` and read back as null; a null url leaves out the target; rows that share both the
smallest id and the payload are all responses; an empty table gives an archive without
records; files with damaged members yield their good records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

# An empty gzip member.  It stands between records because Spark's text sink wants a
# separator; gzip readers see nothing there, and the sink's commit protocol makes the
# archives safe against lost executors and repeated tasks on any Hadoop file system.
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + bytes(8)
MAGIC = b"\x1f\x8b\x08"
RANGE_BYTES = 16 << 20
BLOCK = 1 << 20
EPOCH = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                 min_bytes: int = 0) -> DataFrame:
    """Decide for each row whether it is a response or revisits an earlier equal payload."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("order_id"), F.col(url_col).alias("url"),
                        payload.alias("payload")).withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")})
    first = (rows.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes")
             .agg(F.min("order_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 and first_id is not null").drop("n"))
    revisits = F.col("first_id").isNotNull() & ~F.col("order_id").eqNullSafe(F.col("first_id"))
    return rows.join(first, ["digest", "bytes"], "left").select(
        "id", "url", "digest", "bytes", F.when(revisits, F.col("first_id").cast("string")).alias("refers_to"),
        F.when(~revisits, F.col("payload")).alias("payload"))


def _uri(page_id: str | None) -> str:
    return f"<urn:page:{quote(page_id, safe='') if page_id is not None else 'null'}>"


def encode_record(page_id: str | None, url: str | None, digest: str, size: int, refers_to: str | None,
                  payload: bytes | None) -> bytes:
    """One gzip member: a response with its payload, or a revisit with the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: {_uri(page_id)}",
            f"WARC-Date: {EPOCH}", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    block = http + (payload or b"")
    raw = "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def write_archives(records: DataFrame, path: str) -> None:
    """Write ``plan_records`` rows as WARC files under ``path``, one file per task."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            members = [encode_record(r["id"], r["url"], r["digest"], r["bytes"], r["refers_to"], r["payload"]) for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["member"])

    (records.mapInArrow(build, "member binary").select(F.col("member").cast("string"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path))


class _File:
    """Bytes of an open file by position, read in blocks and kept from ``drop`` on."""

    def __init__(self, f, size: int, start: int):
        self.f, self.size, self.base, self.buf = f, size, start, b""

    def need(self, end: int) -> bytes:
        """The kept bytes, reaching to ``end`` or the end of the file."""
        end = min(end, self.size)
        have = self.base + len(self.buf)
        if end > have:
            self.f.seek(have)
            self.buf += self.f.read(max(end - have, min(BLOCK, self.size - have)))
        return self.buf

    def drop(self, to: int) -> None:
        if to > self.base:
            self.buf, self.base = self.buf[to - self.base:], to


def _member(src: _File, at: int) -> tuple[bytes, int] | None:
    """The decoded WARC member at ``at`` and the position after it; None if there is none."""
    z, parts, pos = zlib.decompressobj(31), [], at
    first = True
    while not z.eof:
        src.need(pos + 1)
        chunk = src.buf[pos - src.base:pos - src.base + (512 if first else BLOCK)]
        if not chunk:
            return None
        try:
            out = z.decompress(chunk)
        except zlib.error:
            return None
        parts.append(out)
        pos += len(chunk)
        seen = parts[0] if len(parts) == 1 else b"".join(parts[:8])
        if len(seen) >= 5 or z.eof:
            if not seen.startswith(b"WARC/"):
                return None
            first = False
    pos -= len(z.unused_data)
    after = src.need(pos + 3)[pos - src.base:pos - src.base + 3]
    return (b"".join(parts), pos) if pos >= src.size or after == MAGIC[:len(after)] else None


def _parse(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = fields.get("content-length", "")
    block = rest[:int(size)] if size.isdigit() else rest.removesuffix(b"\r\n\r\n")
    http, _, payload = block.partition(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else (b"", b"", block)
    declared = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", b"\r\n" + http)
    kind = fields.get("warc-type")
    if kind == "revisit":
        digest, n = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, int(declared[1]) if declared else None
    else:
        digest, n = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
    return {"record_type": kind, "record_id": fields.get("warc-record-id"), "target_uri": fields.get("warc-target-uri"),
            "refers_to": fields.get("warc-refers-to"), "payload_digest": digest, "payload_bytes": n,
            "declared_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, "payload": payload}


def scan_range(f, size: int, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """(offset, record) of every record that starts in [start, end) of the open file."""
    src, at = _File(f, size, start), start
    while at < end:
        src.drop(at)
        src.need(min(at + BLOCK, end + 2))
        stop = src.base + len(src.buf)
        i = src.buf.find(MAGIC)
        if i < 0 or src.base + i >= end:
            if stop >= min(end + 2, size):
                return
            at = stop - 2
            continue
        at = src.base + i
        found = _member(src, at)
        if found:
            yield at, _parse(found[0])
            at = found[1]
        else:
            at += 1


RECORD = StructType([StructField(n, t) for n, t in (
    ("path", StringType()), ("offset", LongType()), ("record_type", StringType()), ("record_id", StringType()),
    ("target_uri", StringType()), ("refers_to", StringType()), ("payload_bytes", LongType()),
    ("payload_digest", StringType()), ("declared_digest", StringType()), ("payload", BinaryType()))])


def read_archives(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """Records of all WARC files under ``path`` (see RECORD for the columns)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    ranges = files.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    tasks = max(1, ranges.count())
    schema = RECORD if with_payload else StructType(RECORD.fields[:-1])
    names = schema.names

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        arrow = pa.schema([(f.name, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in schema])
        for b in batches:
            for r in b.to_pylist():
                store, inner = fs.FileSystem.from_uri(r["path"])
                rows, held = [], 0
                with store.open_input_file(inner) as f:
                    for offset, rec in scan_range(f, r["length"], r["start"], r["start"] + range_bytes):
                        rec |= {"path": r["path"], "offset": offset}
                        rows.append({n: rec[n] for n in names})
                        held += len(rec["payload"]) if with_payload else 0
                        if len(rows) >= 1000 or held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    # one range per task, dealt round robin
    return ranges.repartition(tasks).mapInArrow(scan, schema)


def page_records(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """What the archives say about each page: id, size, digest, type, and the page revisited."""
    def page_id(c: str):
        return F.url_decode(F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("null"))).cast(id_type)
    return read_archives(spark, path, with_payload=False).select(
        page_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_id("refers_to").alias("refers_to"))
