"""WARC archives: one gzip member per record, written by Spark's own file committer and read back sequentially.

Writing. Each row becomes one record, each record one gzip member, and Spark's text writer puts the members of a task one
after another into a file. A text line must end in a separator; the separator chosen is the byte 0, which is the last byte
of every gzip member whose content is shorter than 16 MiB (the high byte of the little-endian ISIZE), so the member is
handed over without it. Longer records get an empty gzip member after them, whose ISIZE is 0. The files are thus plain
concatenated gzip members, and a lost executor's attempt is redone by the committer like any other Spark write.

Reading. Each archive is decompressed incrementally with zlib, member by member; records are framed by Content-Length and
payload and block digests are verified.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import attach_groups, materialize, new_path

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads shorter than this are never revisits. Zero: all payloads count.
LEAST_BYTES = 0
#: Records per archive: bounds an archive's size, as a reader's task holds one compressed archive.
RECORDS_PER_ARCHIVE = 2_000
#: Bytes fed to zlib at once.
STEP = 1 << 16
EMPTY_MEMBER = zlib.compressobj(6, zlib.DEFLATED, 31).flush()


class WarcError(ValueError):
    """An archive that breaks the format, or a digest that does not fit."""


def digest_of(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def digest_column(payload: Column) -> Column:
    """digest_of as a column: 40 bits of the hex digest at a time, in base 32."""
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = [F.lpad(F.conv(F.substring(F.sha1(payload), 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), digits, letters)


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    payload: bytes
    http: dict[str, str] = field(default_factory=dict)


def _clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP header, which tells the full payload's length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{digest_of(block)}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """The record's gzip member without its last byte, which is 0; see the module's text."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = z.compress(record) + z.flush()
    if data[-1]:
        data += EMPTY_MEMBER
    return data[:-1]


def members(data: bytes | memoryview) -> Iterator[bytes]:
    """The decompressed gzip members of an archive, one at a time, fed to zlib in steps. Empty members are passed over."""
    view, at = memoryview(data), 0
    while at < len(view):
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            if at >= len(view):
                raise WarcError("the archive ends inside a gzip member")
            chunk = view[at : at + STEP]
            try:
                parts.append(z.decompress(chunk))
            except zlib.error as e:
                raise WarcError(f"no gzip member at byte {at}: {e}") from e
            at += len(chunk) - len(z.unused_data)
        if out := b"".join(parts):
            yield out


def _headers(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError(f"header line without a colon: {line[:40]!r}")
        out[name.decode("utf-8").strip().lower()] = value.decode("utf-8").strip()
    return out


def parse(record: bytes) -> Record:
    """Frame one record by its Content-Length, split off the HTTP header, and verify both digests."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not gap or not first.startswith(b"WARC/"):
        raise WarcError("the record has no WARC header")
    headers = _headers(lines)
    length = int(headers["content-length"])
    block, tail = rest[:length], rest[length:]
    if len(block) != length or tail != b"\r\n\r\n":
        raise WarcError("the block does not have the length that Content-Length gives")
    if (want := headers.get("warc-block-digest")) and want != f"sha1:{digest_of(block)}":
        raise WarcError("the block digest does not fit")
    status, _, payload = block.partition(b"\r\n\r\n")
    http = _headers(status.split(b"\r\n")[1:]) if headers.get("content-type", "").startswith("application/http") else {}
    if not http:
        payload = block
    if headers.get("warc-type") == "response":
        if (want := headers.get("warc-payload-digest")) and want != f"sha1:{digest_of(payload)}":
            raise WarcError("the payload digest does not fit")
    return Record(headers, block, payload, http)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = LEAST_BYTES) -> None:
    """Write one record per row of pages under path. Of rows with equal payloads of at least least_bytes bytes, the one with
    the largest id is a response (all that tie on it, where rows repeat), the others revisit it.

    A null payload is the empty one; null ids never are referred to, and rows whose whole group has null ids are responses;
    a record without a URL has no target. Control characters in URLs are percent-encoded. An empty table writes no record.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("_url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("_payload"))
    keyed = rows.withColumn("_digest", F.when(F.length("_payload") >= least_bytes, digest_column(F.col("_payload"))))
    grouped = keyed.filter("_digest IS NOT NULL").groupBy("_digest").agg(F.max("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # only groups of several rows matter; most payloads are alone in theirs
    shared = materialize(grouped.filter("_n > 1"), "payload-groups")
    placed = attach_groups(keyed, shared, "_digest", "_n", F.xxhash64("_id")).select("_id", "_url", "_payload", "_first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, url, payload, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                revisit = first is not None and first != i
                out.append(member(record_bytes(i, url, payload, digest_of(payload), first, revisit)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    records = placed.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    records.write.option("lineSep", "\0").option("compression", "none").option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under path: page_id, url, record_type, payload_bytes and payload_digest (of the full
    payload, also for revisits), refers_to, payload (null for revisits). Broken archives and digests raise WarcError."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")

    def number(uri: str | None) -> int | None:
        return int(m[1]) if uri and (m := re.fullmatch(r"<urn:page:(-?\d+)>", uri)) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for archive in batch.column(0):
                rows, held = [], 0
                for data in members(archive.as_buffer()):
                    r = parse(data)
                    revisit = r.headers["warc-type"] == "revisit"
                    rows.append((number(r.headers["warc-record-id"]), r.headers.get("warc-target-uri"), r.headers["warc-type"], int(r.http.get("content-length", len(r.payload))), r.headers["warc-payload-digest"].removeprefix("sha1:"), number(r.headers.get("warc-refers-to")), None if revisit else r.payload))
                    held += len(data)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    # one archive at a time: binaryFile rows are whole files
    return files.mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGIT = "substr('" + _LETTERS + "', 1 + (((('0x' || substr(h, {a}, 10))::BIGINT) >> {b}) & 31)::INTEGER, 1)"
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t) AS payload_bytes, sha1(t) AS h FROM p),
e AS (SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {" || ".join(_DIGIT.format(a=1 + 10 * i, b=35 - 5 * j) for i in range(4) for j in range(8))} AS payload_digest FROM d),
f AS (SELECT payload_digest, max(page_id) AS first FROM e GROUP BY 1)
SELECT e.page_id, e.payload_bytes, e.payload_digest, CASE WHEN e.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN e.page_id <> f.first THEN f.first END AS refers_to
FROM e JOIN f USING (payload_digest)
"""
