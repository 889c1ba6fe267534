"""WARC archives: round trip, index, coalesced reads, odd rows."""

from __future__ import annotations

import gzip
import hashlib

from wagegrid.llm import warc
from wagegrid.llm.shared import shared_path

PAGES = "page_id bigint, url string, html string, digest string, first bigint"


def test_odd_pages(llm):
    big, small = "x" * 1000 + "é", "y" * 999
    rows = [(1, "http://a/ b\n", big, "d", 1), (2, None, big, None, None), (5, "http://c/%41?q=é", big, "d", 1),
            (5, "http://c/2", big, "d", 1), (3, "u", small, "", 0), (4, "u", small, "", 0),
            (6, "u", None, None, None), (7, "u", "", None, None), (None, "u", big, None, None)]
    folder = shared_path(llm, "warc-test")
    index = warc.write_archives(llm.createDataFrame(rows, PAGES).repartition(3), folder)
    got = warc.read_records(index, folder).collect()
    assert len(got) == len(rows)
    assert sorted((r.page_id or -1, r.url) for r in got) == sorted((p or -1, u or "") for p, u, *_ in rows)
    for r in got:
        html = next(h for p, u, h, *_ in rows if p == r.page_id) or ""
        assert r.payload_bytes == len(html.encode())
        assert r.payload_digest == hashlib.sha1(html.encode()).hexdigest()
        revisit = r.page_id in (1, 2)
        assert r.record_type == ("revisit" if revisit else "response")
        assert r.refers_to == (5 if revisit else None)
        assert r.payload == (b"" if revisit else html.encode())


def test_very_long_payloads(llm):
    long = "".join(f"<p>{k} é</p>" for k in range(400_000))
    rows = [(1, "http://a/", long, "", 0), (2, "http://b/", long, "", 0), (3, "http://c/", long[:-1], "", 0)]
    folder = shared_path(llm, "warc-test")
    index = warc.write_archives(llm.createDataFrame(rows, PAGES), folder)
    got = {r.page_id: r for r in warc.read_records(index, folder).collect()}
    for page, _, html, *_ in rows:
        assert got[page].payload_bytes == len(html.encode()) > 5_000_000
        assert got[page].payload_digest == hashlib.sha1(html.encode()).hexdigest()
        assert got[page].payload == (b"" if page == 1 else html.encode())
    assert (got[1].record_type, got[1].refers_to, got[3].record_type) == ("revisit", 2, "response")


def test_index_points_at_whole_members(llm, sf):
    folder = shared_path(llm, "warc-test")
    pages = llm.read.parquet(f"{sf}/pages.parquet")
    index = warc.write_archives(pages, folder).collect()
    assert len(index) == pages.count()
    for row in index[:20]:
        with open(row.file, "rb") as file:
            file.seek(row.offset)
            text = gzip.decompress(file.read(row.length))
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
        assert warc.decode_record(gzip.compress(text))["page_id"] == row.page_id


def test_selected_records_only(llm, sf):
    folder = shared_path(llm, "warc-test")
    index = warc.write_archives(llm.read.parquet(f"{sf}/pages.parquet"), folder)
    some = index.where("page_id % 7 = 3")
    assert (sorted(r.page_id for r in warc.read_records(some, folder, gap=0).collect())
            == sorted(r.page_id for r in some.collect()))


def test_coalescing():
    rows = [("f", 0, 10), ("f", 10, 5), ("f", 40, 5), ("f", 200, 5), ("g", 0, 5)]
    assert [(f, s, n, len(r)) for f, s, n, r in warc.coalesced(rows, 30, 1000)] == [
        ("f", 0, 45, 3), ("f", 200, 5, 1), ("g", 0, 5, 1)]
    assert [(s, n) for _, s, n, _ in warc.coalesced(rows[:3], 30, 16)] == [(0, 15), (40, 5)]


def test_no_pages(llm):
    folder = shared_path(llm, "warc-test")
    index = warc.write_archives(llm.createDataFrame([], PAGES), folder)
    assert warc.read_records(index, folder).collect() == []
