"""Operator 3: round trips, revisits, salvage of damaged archives."""

import base64
import gzip
import hashlib
import random

import duckdb

from lapse.llm import warc
from lapse.llm.queries import QUERIES, SQL

from .conftest import SF001

PAGES = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def written(spark, rows, **how):
    path = warc.new_archive_path(spark)
    warc.write_archives(spark.createDataFrame(rows, PAGES), path, **how)
    return path


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF001}/pages.parquet')")
    got = QUERIES["op3_warc"](spark, SF001)
    want = con.sql(SQL["op3_warc"])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_odd_pages(spark):
    big = "x\r\n\r\nWARC/1.1\r\n" * 5000
    rows = [
        (1, "http://a/\r\nWARC-Type: x", "same"), (2, None, "same"), (3, "u", "same"), (4, "u", None), (5, "u", ""), (6, "é", big),
        (None, "u", "alone"), (None, "u", "both"), (8, "u", "both"), (9, "u", "twin"), (9, "u", "twin"),
        (10, "u", "\r\n\r\n"), (11, "u", "\x00😀\n"),
    ]
    path = written(spark, rows, archive_bytes=2000)
    read = warc.read_archives(spark, path)
    assert warc.gaps(read).count() == 0
    got = sorted(((r.id, r.type, r.refers_to, r.payload_bytes, r.payload_digest) for r in read.collect()), key=str)
    name = lambda i: f"urn:x-page:{'none' if i is None else i}"
    top = {"same": 3, "both": 8, "": 5, "twin": 9}
    want = []
    for i, _, h in rows:
        t = top.get(h or "", i)
        want.append((name(i), "response" if i == t else "revisit", None if i == t else name(t), len((h or "").encode()), digest(h)))
    assert got == sorted(want, key=str)
    bodies = sorted(bytes(r.payload).decode() for r in warc.resolved(read).collect())
    assert bodies == sorted(h or "" for _, _, h in rows)


def test_short_payloads_are_all_responses(spark):
    path = written(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], min_bytes=3)
    assert sorted((r.id[-1], r.type) for r in warc.read_archives(spark, path).collect()) == [
        ("1", "response"), ("2", "response"), ("3", "revisit"), ("4", "response")]


def test_empty_table(spark):
    assert warc.records(spark.createDataFrame([], PAGES)).collect() == []


def records(n):
    out = []
    for i in range(n):
        block = f"HTTP/1.1 200 OK\r\n\r\nbody {i} ".encode() * (i + 1)
        head = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:{i}>\r\nWARC-Block-Digest: sha1:{warc.sha1_base32(block)}\r\n"
                f"Content-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n")
        out.append(head.encode() + block + b"\r\n\r\n")
    return out


def ids(found):
    return [h["warc-record-id"][12:-1] for k, _, _, h, _ in found if k == "record"]


def covered(found, size):
    at = 0
    for _, start, end, _, _ in found:
        assert start == at
        at = end
    assert at == size


def test_salvage_recovers_the_records_after_damage():
    recs = records(6)
    for pack in (lambda r: r, gzip.compress):
        parts = [pack(r) for r in recs]
        whole = b"".join(parts)
        assert ids(list(warc.salvage(whole))) == list("012345")
        edge = [sum(map(len, parts[:i])) for i in range(7)]
        for change in (
            lambda b: b[: edge[2] + 30] + b"?" * 8 + b[edge[2] + 38 :],  # overwritten
            lambda b: b[: edge[2] + 60] + b[edge[3] :],  # cut short
            lambda b: b[: edge[2]] + b"\x1f\x8b\x08 WARC/9 noise" + b[edge[3] :],  # noise that looks like a start
        ):
            data = change(whole)
            found = list(warc.salvage(data))
            covered(found, len(data))
            assert ids(found) == list("01345")
            assert [k for k, *_ in found].count("gap") == 1 and all(h.get("check") for k, _, _, h, _ in found if k == "gap")
        cut = whole[: edge[5] + 20]
        assert ids(list(warc.salvage(cut))) == list("01234")
    assert list(warc.salvage(b"")) == []
    assert [k for k, *_ in warc.salvage(b"no archive")] == ["gap"]


def test_salvage_never_crashes_and_covers_all_bytes():
    rng = random.Random(4)
    whole = b"".join(records(4) + [gzip.compress(r) for r in records(4)])
    for _ in range(200):
        data = bytearray(whole)
        for _ in range(rng.randint(1, 6)):
            data[rng.randrange(len(data))] = rng.randrange(256)
        covered(list(warc.salvage(bytes(data))), len(data))


def test_gaps_are_logged_by_the_reader(spark, tmp_path):
    recs = records(3)
    (tmp_path / "x.warc").write_bytes(recs[0] + b"torn" + recs[1] + recs[2][:-9])
    read = warc.read_archives(spark, f"file://{tmp_path}")
    assert sorted(r.id for r in read.filter("kind = 'record'").collect()) == ["urn:x-page:0", "urn:x-page:1"]
    n = len(recs[0])
    assert sorted((r.start, r.end, r.failed_check) for r in warc.gaps(read).collect()) == [
        (n, n + 4, "version line"), (n + 4 + len(recs[1]), n + 4 + len(recs[1]) + len(recs[2]) - 9, "length or closing blank lines")]


def _plain(i: int, body: bytes) -> bytes:
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:{i}>\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def test_salvage_takes_linear_time():
    """Many members, many damaged records and records without any blank line: seconds, not minutes."""
    import gzip
    import time

    from lapse.llm import warc

    whole = b"".join(gzip.compress(_plain(i, b"x" * 20), 1) for i in range(40_000))
    damaged = b"".join(_plain(i, b"y" * 400).replace(b"Content-Length: 400", b"Content-Length: 401") for i in range(30_000))
    for data, kinds in ((whole, {"record": 40_000}), (damaged, {"gap": 1}), (damaged.replace(b"\r\n\r\n", b"\r\n"), {"gap": 1})):
        begin = time.process_time()
        rows = [(kind, start, end) for kind, start, end, _, _ in warc.salvage(data)]
        assert time.process_time() - begin < 5
        assert {k: sum(r[0] == k for r in rows) for k in kinds} == kinds and len(rows) == sum(kinds.values())
        assert [r[1] for r in rows] == [0, *(r[2] for r in rows[:-1])] and rows[-1][2] == len(data)
