"""WARC archives: round trip, frames, revisits, defined cases."""

from __future__ import annotations

import hashlib
import struct

import duckdb

from cardlake.llm import warc as W


def test_round_trip_of_an_archive():
    page = lambda k: (b"<html><head><title>page %d</title></head><body>" % k) + b"<p>some text in common</p>" * 40 + b"</html>"
    records = [W.record(k, f"http://x/{k}\r\n", page(k), hashlib.sha1(page(k)).hexdigest(), None) for k in range(60)]
    records.append(W.record(99, "http://x/99", page(1), hashlib.sha1(page(1)).hexdigest(), 1))
    archive = W.build_archive(records)
    magic, size = struct.unpack_from("<II", archive)
    assert magic == W.MAGIC and 0 < size <= W.DICTIONARY_BYTES
    got = list(W.read_records(archive))
    assert len(got) == 61
    for k, (head, block) in enumerate(got[:60]):
        assert head["WARC-Record-ID"] == f"<urn:x-page:{k}>" and block.partition(b"\r\n\r\n")[2] == page(k)
    assert got[60][0]["WARC-Type"] == "revisit" and got[60][0]["WARC-Refers-To"] == "<urn:x-page:1>"
    assert len(archive) < sum(map(len, records)) / 3


def expected(rows):
    digest = lambda h: hashlib.sha1((h or "").encode()).hexdigest()
    out = []
    for i, h in rows:
        size = len((h or "").encode())
        same = [j for j, g in rows if digest(g) == digest(h) and j is not None]
        first = max(same) if size >= 1000 and same else i
        out.append((i, size, digest(h), "response" if first == i else "revisit", None if first == i else first))
    return sorted(out, key=str)


def test_rows(spark, tmp_path):
    big = "é" * 700
    rows = [(1, big), (2, big), (5, big), (None, big), (3, "x" * 999), (4, "x" * 999), (6, None), (7, ""), (8, "y" * 3_000_000),
            (9, "\r\n\r\nWARC/1.1\r\n"), (10, "z" * 1000), (10, "z" * 1000)]
    df = spark.createDataFrame([(i, None if i == 1 else f"http://h/{i}", h, "d", 0) for i, h in rows],
                               "page_id long, url string, html string, digest string, first int")
    archives = W.write_archives(df)
    got = W.read_archives(archives).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows)
    html = {i: (h or "").encode() for i, h in rows}
    assert all(bytes(r.payload) == html[r.page_id] for r in got if r.record_type == "response")
    W.export_archives(archives, str(tmp_path))
    files = sorted(tmp_path.glob("*.warc.zst"))
    assert sum(len(list(W.read_records(f.read_bytes()))) for f in files) == len(rows)
    assert W.read_archives(W.write_archives(df.limit(0))).count() == 0


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute("create view pages as select * from '/root/testdata/sf0.001/pages.parquet'")
    want = con.execute(W.OP9_SQL).fetchall()
    got = [tuple(r) for r in W.op9_warc_dictionary(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
