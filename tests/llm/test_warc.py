"""WARC archives: written, split and read back, against a plain reading of the table and of the files."""

import base64
import gzip
import hashlib
import os
import random
import zlib

import duckdb
import pyarrow as pa
import pytest

from chronicle.llm import oracles, queries, warc


def b32(x):
    return base64.b32encode(hashlib.sha1(x).digest()).decode()


def brute(rows, least=0):
    """By the contract: (page_id, bytes, digest, type, refers_to) of (page_id, url, payload)."""
    out, groups = [], {}
    for page_id, url, payload in rows:
        groups.setdefault(payload or b"", []).append((page_id is None, page_id or 0, url is None, url or "", page_id))
    for payload, members in groups.items():
        members.sort()
        for k, m in enumerate(members):
            again = k > 0 and len(payload) >= least
            out.append((m[4], len(payload), b32(payload), "revisit" if again else "response", members[0][4] if again else None))
    return sorted(out, key=repr)


def pages(seed=1):
    r = random.Random(seed)
    bodies = [b"", b"<p>one</p>", b"<p>two</p>" * 400, "Grüße  ".encode(), os.urandom(5000), *(str(r.random()).encode() * r.randint(1, 400) for _ in range(40))]
    rows = [(i, f"http://h/{i % 7}", r.choice(bodies)) for i in r.sample(range(1000), 150)]
    rows += [(7001, None, None), (7001, None, None), (None, "http://x", b"<p>one</p>"), (None, None, bodies[-1]), (7002, "http://e\r\nPage-Id: 5\x00 ", b"hostile"), (3, "u", b"same"), (3, "u", b"same"), (3, "t", b"same"), (-4, "", b"same")]
    r.shuffle(rows)
    return rows


SCHEMA = "page_id long, url string, html binary"


def test_round_trip(spark):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("page_id", "Page").selectExpr("Page AS page_id", "url", "html", "1 AS hash", "2 AS first").repartition(5)
    for least in (0, 11, 6000):
        got = warc.round_trip(df, least, archive_bytes=20_000)
        assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, least)


@pytest.mark.parametrize("split", [97, 1000, 1 << 20])
def test_splits_and_files(spark, tmp_path, split):
    rows = pages(2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    made = warc.written(df, f"file://{tmp_path}/w", archive_bytes=15_000)
    manifest = made.collect()
    assert len(manifest) > 3 and sum(m["records"] for m in manifest) == len(rows)
    listed = warc.archives(spark, str(tmp_path / "w"))
    assert sorted((os.path.basename(r["path"]), r["bytes"]) for r in listed.collect()) == sorted((os.path.basename(m["path"]), m["bytes"]) for m in manifest)
    found = warc.records(listed, split, with_payload=True).collect()
    assert all(r["intact"] for r in found)
    want = brute(rows)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found), key=repr) == want
    for r in found:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
        assert r["payload"] is None or b32(r["payload"]) == r["payload_digest"]
    for m in manifest:  # any reader of gzip can read them, record by record
        with open(m["path"].removeprefix("file://"), "rb") as f:
            whole = gzip.decompress(f.read())
        assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == m["records"]


def nested_archive(n=40):
    """An archive as a payload; in a member that is stored, not compressed, its members stand byte for byte."""
    return b"".join(warc.member(9000 + i, f"http://inner/{i}", os.urandom(700)) for i in range(n))


def test_archives_inside_payloads(spark, tmp_path):
    """A range that begins inside such a payload takes its records for the file's; the file is then read from its beginning."""
    inner = nested_archive()
    rows = [(i, f"http://o/{i}", inner + bytes([i]) if i % 3 == 0 else b"x" * i) for i in range(12)]
    (tmp_path / "w").mkdir()
    (tmp_path / "w/a.warc.gz").write_bytes(b"".join(warc.member(*r, level=0) for r in rows))
    (tmp_path / "w/b.warc.gz").write_bytes(warc.member(50, "http://o/50", b"plain"))
    files = warc.archives(spark, str(tmp_path / "w"))
    ranges = files.selectExpr("path", "bytes", "explode(sequence(0L, bytes - 1, 5000L)) AS start").selectExpr("path", "start", "least(bytes, start + 5000) AS end")
    fooled = warc._scanned(ranges, 4, False)
    assert fooled.where("page_id >= 9000").count() > 0 and warc.gaps(fooled, files).count() > 0
    got = warc.records(files, 5000, with_payload=True)
    assert sorted((r["page_id"], r["url"], bytes(r["payload"])) for r in got.collect()) == sorted([*rows, (50, "http://o/50", b"plain")])
    assert warc.gaps(got, files).count() == 0
    assert warc.records(files, 5000).where("page_id >= 9000").count() == 0


def test_damage_is_told(spark, tmp_path):
    parts = [warc.member(i, f"u{i}", str(i).encode() * 50) for i in range(6)]
    flaw = bytearray(parts[2])
    flaw[len(flaw) // 2] ^= 0xFF
    (tmp_path / "a.warc.gz").write_bytes(b"junk" + parts[0] + parts[1] + bytes(flaw) + b"\x1f\x8b\x08" * 5 + parts[3] + parts[4] + parts[5][:-9])
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    files = warc.archives(spark, str(tmp_path))
    found = warc.records(files, 50)
    assert sorted(r["page_id"] for r in found.collect()) == [0, 1, 3, 4]
    cut = 4 + len(parts[0]) + len(parts[1])
    stop = cut + len(flaw) + 15
    assert sorted((r["at"], r["start"]) for r in warc.gaps(found, files).collect()) == [(0, 4), (cut, stop), (stop + len(parts[3]) + len(parts[4]), os.path.getsize(tmp_path / "a.warc.gz"))]


def test_other_records(tmp_path):
    """Records of other makers: fields in any case, no HTTP message, a wrong digest, further members."""
    def packed(head, block):
        return gzip.compress(head + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n")

    info = packed(b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-RECORD-ID: <urn:a>\r\nWARC-Date: x\r\nContent-Type: application/warc-fields\r\n", b"software: x\r\n")
    bad = packed(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:b>\r\nWARC-Date: x\r\nContent-Type: application/http\r\nWARC-Payload-Digest: sha1:AAAA\r\n", b"HTTP/1.0 200\r\nA: b\r\n\r\nbody")
    odd = gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:c>\r\nWARC-Date: x\r\nContent-Length: 999\r\n\r\nshort\r\n\r\n")
    (tmp_path / "x.gz").write_bytes(info + bad + odd)
    with pa.OSFile(str(tmp_path / "x.gz")) as f:
        found = [warc._row("p", *r, True) for r in warc.scan(f, 0, 1 << 20)]
    assert [(r[3], r[7], r[9], r[10]) for r in found] == [("warcinfo", 13, True, b"software: x\r\n"), ("response", 4, False, b"body")]


def test_empty_and_query(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(empty).count() == 0
    rows = [(i, u, None if p is None else p.decode("utf-8", "replace")) for i, u, p in pages(3)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op12_warc(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.sql(oracles.SQL["op12_warc"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
    assert sorted(want.fetchall() or map(tuple, got.collect()), key=repr) == brute([(i, u, None if t is None else t.encode()) for i, u, t in rows])


def test_member_is_deterministic():
    assert warc.member(1, "u", b"x") == warc.member(1, "u", b"x") and zlib.crc32(warc.member(1, "u", b"x")) != zlib.crc32(warc.member(2, "u", b"x"))
