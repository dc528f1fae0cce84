"""Operator 3: WARC writer and salvage reader.

Writing: every page becomes one record with an HTTP message as its block.  Of pages with equal
payloads (at least ``min_bytes`` long) the one with the largest id is written as a response, the
others as revisits that refer to it and carry no payload.  Records are text rows of Spark's text
sink with the record's closing blank lines as the line separator, so archives are plain WARC files on
any file system Spark can write, committed by Spark; within a task a new archive begins after
``ARCHIVE_BYTES``.

Reading: each archive is parsed record by record; version line, headers, length, closing blank
lines and block digest are checked.  Where a check fails, the reader searches for the next place that
parses - a version line, or the first bytes of a gzip member, whose record passes all checks -
goes on there, and reports the bytes between as a gap with the failed check.

Defined cases: a null html is an empty payload; equal largest ids in one group are all responses;
a null id is smaller than any and all-null groups are all responses; control characters in urls
are percent-encoded; a missing url is an empty one; an empty table gives no records; further columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.session import ensure_checkpoint_dir
from lapse.sources.store import materialize

ARCHIVE_BYTES = 16 << 20
URN = "urn:x-page:"
#: RFC 4648 base32 letters in order (fixed values)
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CLOSE = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
GAP = "gap"


def base32_sha1(body: Column) -> Column:
    """Bare upper-case base32 SHA-1: ten hex digits are eight base-32 digits."""
    digest = F.sha1(body)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, payload_bytes, digest, response_id): response_id is null for
    responses and the response's id for revisits."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    one = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                       payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                       base32_sha1(payload).alias("digest"))
    # counted before the shuffle; only payloads met more than once take part in the join.  Their
    # table is stored, so Spark plans the join by its real size: while it is small the payloads
    # are not shuffled
    top = materialize(
        one.filter(F.col("payload_bytes") >= min_bytes).groupBy("digest", "payload_bytes")
        .agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select(F.col("digest").alias("_d"), F.col("payload_bytes").alias("_b"), "top"), "warc-repeated",
    )
    j = one.join(top, (F.col("digest") == F.col("_d")) & (F.col("payload_bytes") == F.col("_b")), "left")
    again = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return j.select("page_id", "url", "payload", "payload_bytes", "digest", F.when(again, F.col("top")).alias("response_id"))


def records(pages: DataFrame, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(record): the text of every record up to its closing blank lines."""
    p = with_revisits(pages, min_bytes)
    revisit = F.col("response_id").isNotNull()
    # an id of null stays apart from every number
    name = lambda c: F.concat(F.lit(f"<{URN}"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    block = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), "payload"))
    url = F.col("url")
    for code in (*range(33), 127):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    p = p.withColumn("block", block)
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name("page_id")), line("WARC-Date", F.lit(date)), line("WARC-Target-URI", url),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", name("response_id")))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")), line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("block")))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")), F.lit("\r\n"),
    )
    return p.select(F.concat(head, F.col("block")).alias("record"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write one record per page below ``path``, in archives of about ``archive_bytes`` each."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, k = 0, 0
        for b in batches:
            at = []
            for r in b.column(0):
                size = len(r.as_buffer())
                if full and full + size > archive_bytes:
                    full, k = 0, k + 1
                full += size
                at.append(k)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at, pa.int32())], names=["record", "archive"])

    numbered = records(pages, min_bytes).mapInArrow(number, "record string, archive int")
    numbered.write.mode("error").partitionBy("archive").option("lineSep", CLOSE).text(path)


class Bad(Exception):
    """A failed check."""


class Marks:
    """Next places of byte strings in an archive; what lies between a search and its finding is not searched again."""

    def __init__(self, data: bytes) -> None:
        self.data = data
        self.known: dict[bytes, tuple[int, int]] = {}

    def next(self, mark: bytes, at: int) -> int:
        """First place of the mark at or after a position; the length of the data if there is none."""
        since, place = self.known.get(mark, (0, -1))
        if not since <= at <= place:
            place = self.data.find(mark, at)
            since, place = at, place if place >= 0 else len(self.data)
            self.known[mark] = (since, place)
        return place


def parse_record(data: bytes, at: int, marks: Marks | None = None) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record at a position; raises Bad with the failed check."""
    marks = marks or Marks(data)
    m = VERSION.match(data, at)
    if not m:
        raise Bad("version line")
    stop = marks.next(b"\r\n\r\n", m.end() - 2)
    if stop == len(data):
        raise Bad("headers without end")
    head: dict[str, str] = {}
    line = m.end()
    while line <= stop:  # line by line: damaged headers fail long before their end
        line_end = min(marks.next(b"\r\n", line), stop)
        key, colon, value = data[line:line_end].partition(b":")
        line = line_end + 2
        if not colon or not key.strip():
            raise Bad("header line")
        name = key.strip().decode("latin-1").lower()
        if name in head and name != "warc-concurrent-to":  # two records run into each other
            raise Bad("header twice")
        head[name] = value.strip().decode("utf-8", "replace")
    if "warc-type" not in head or "warc-record-id" not in head:
        raise Bad("mandatory header")
    length = head.get("content-length", "")
    if not length.isdigit():
        raise Bad("content length")
    begin, end = stop + 4, stop + 4 + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Bad("length or closing blank lines")
    block = data[begin:end]
    want = head.get("warc-block-digest", "")
    if want.startswith("sha1:") and want[5:] != sha1_base32(block):
        raise Bad("block digest")
    return head, block, end + 4


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def inflate(data: bytes, at: int) -> tuple[bytes, int]:
    """(content, end) of the gzip member at a position, read in growing pieces so that a member costs its own size."""
    d, out, view, piece = zlib.decompressobj(31), [], memoryview(data), 1 << 10
    try:
        while not d.eof and at < len(data):
            out.append(d.decompress(view[at : at + piece]))
            at = min(at + piece, len(data))
            piece = min(2 * piece, 1 << 20)
    except zlib.error as e:
        raise Bad("gzip member") from e
    if not d.eof:
        raise Bad("gzip member without end")
    return b"".join(out), at - len(d.unused_data)


def salvage(data: bytes) -> Iterator[tuple[str, int, int, dict[str, str], bytes]]:
    """("record", start, end, headers, block) and ("gap", start, end, {"check": ...}, b"") in order;
    together they cover every byte."""
    at, lost, why, marks = 0, -1, "", Marks(data)
    while at < len(data):
        try:
            if data.startswith(MEMBER, at):
                inner, end = inflate(data, at)
                head, block, used = parse_record(inner, 0)
                if used != len(inner):
                    raise Bad("bytes after the record in its member")
            else:
                head, block, end = parse_record(data, at, marks)
        except Bad as bad:
            if lost < 0:
                lost, why = at, str(bad)
            at = min(marks.next(b"WARC/", at + 1), marks.next(MEMBER, at + 1))
            continue
        if lost >= 0:
            yield GAP, lost, at, {"check": why}, b""
            lost = -1
        yield "record", at, end, head, block
        at = end
    if lost >= 0:
        yield GAP, lost, len(data), {"check": why}, b""


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record or gap: (file, kind, start, end, type, id, refers_to, url, payload,
    payload_bytes, payload_digest, failed_check).  A revisit has its payload's size and digest from
    its headers and no payload."""
    schema = ("file string, kind string, start long, end long, type string, id string, refers_to string, url string, "
              "payload binary, payload_bytes long, payload_digest string, failed_check string")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0
        for b in batches:
            for file, content in zip(b.column(0), b.column(1)):
                for kind, start, end, head, block in salvage(content.as_py()):
                    row = [file.as_py(), kind, start, end, *[None] * 7, head.get("check")]
                    if kind != GAP:
                        what = head.get("warc-type")
                        row[4:8] = [what, _bare(head.get("warc-record-id")), _bare(head.get("warc-refers-to")), head.get("warc-target-uri")]
                        if what == "revisit":
                            size = head.get("warc-payload-length", "")
                            row[9:11] = [int(size) if size.isdigit() else None, head.get("warc-payload-digest", "").removeprefix("sha1:")]
                        else:
                            web = head.get("content-type", "").startswith("application/http")
                            body = block.partition(b"\r\n\r\n")[2] if web else block
                            row[8:11] = [body, len(body), sha1_base32(body)]
                    out.append(tuple(row))
                    held += end - start
                    if held > ARCHIVE_BYTES // 4:
                        yield _batch(out, names)
                        out, held = [], 0
        if out:
            yield _batch(out, names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, schema)


def _bare(name: str | None) -> str | None:
    return name.strip("<>") if name else None


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"start": pa.int64(), "end": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array(col, kinds.get(n, pa.string())) for n, col in zip(names, zip(*rows))], names=names)


def gaps(read: DataFrame) -> DataFrame:
    """The log of quarantined bytes: (file, start, end, failed_check)."""
    return read.filter(F.col("kind") == GAP).select("file", "start", "end", "failed_check")


def resolved(read: DataFrame) -> DataFrame:
    """Records whose revisits have the payload of the response they refer to (null if that is lost)."""
    rec = read.filter("kind = 'record'")
    body = rec.filter("type = 'response'").select(F.col("id").alias("_id"), F.col("payload_digest").alias("_digest"), F.col("payload").alias("_body")).dropDuplicates(["_id", "_digest"])
    j = rec.join(body, (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left")
    return j.withColumn("payload", F.coalesce("payload", "_body")).drop("_id", "_digest", "_body")


def new_archive_path(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
