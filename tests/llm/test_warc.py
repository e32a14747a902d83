"""Archives: whole round trips, selected records, coalesced reads, odd rows."""

import gzip
import hashlib
from pathlib import Path

import pytest

from acctlake.llm import warc as W
from acctlake.llm.common import table
from acctlake.session import scratch_dir

SCHEMA = "page_id long, url string, html string"
LONG = "é" * 80


def test_round_trip_of_selected_records(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    folder = scratch_dir(spark, "warc")
    index = W.write_archives(W.plan_records(pages), folder)
    chosen = index.where("page_id % 3 = 0")
    html = {r.page_id: r.html for r in pages.collect()}
    read = W.read_records(chosen, folder, blocks=True).collect()
    assert sorted(r.page_id for r in read) == sorted(i for i in html if i % 3 == 0)
    for row in read:
        if row.record_type == "response":
            assert bytes(row.block).decode() == html[row.page_id]
    # an archive is one gzip member per record, readable as a whole
    for part in Path(folder.removeprefix("file://")).glob("*.warc.gz"):
        assert gzip.decompress(part.read_bytes()).count(b"WARC/1.1\r\n") == index.where(f"file = '{part.name}'").count()


def test_revisits_and_odd_rows(spark):
    rows = [(5, "u", LONG), (3, "u", LONG), (9, "u\r\n x", LONG), (3, "u", LONG), (1, None, None), (2, "v", ""), (4, "v", "short"), (6, "v", "short"),
            (None, "n", LONG), (7, "w", "x" * 99), (8, "w", "x" * 99), (10, "w", "y" * 100), (11, "w", "y" * 100), (10, "w", LONG)]
    pages = spark.createDataFrame([(*r, 1, "f") for r in rows], SCHEMA + ", length int, file string")
    got = sorted(map(tuple, W.archive_and_read(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    firsts = {LONG: 3, "y" * 100: 10}
    expected = []
    for i, _, html in rows:
        payload = (html or "").encode()
        first = firsts.get(html)
        later = first is not None and i is not None and i > first
        expected.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if later else "response", first if later else None))
    assert got == sorted(expected, key=str)
    assert W.archive_and_read(pages.limit(0)).collect() == []


def test_files_are_cut_and_ranges_joined(spark, monkeypatch):
    monkeypatch.setattr(W, "FILE_BYTES", 500)
    monkeypatch.setattr(W, "STRETCH_BYTES", 400)
    pages = spark.createDataFrame([(i, "u", f"{i} " * 50) for i in range(60)], SCHEMA)
    assert W.archive_and_read(pages).where("record_type = 'response'").count() == 60
    assert list(W.coalesced([(0, 10), (10, 5), (100_000, 7), (100_010, 1)])) == [
        (0, 15, [(0, 10), (10, 5)]), (100_000, 100_011, [(100_000, 7), (100_010, 1)])]
    assert list(W.coalesced([])) == []
    assert [len(g) for *_, g in W.coalesced([(0, W.READ_BYTES), (W.READ_BYTES, 5)])] == [1, 1]


def test_damaged_records_are_refused():
    row = {"page_id": 1, "url": "u", "html": "abc", "payload_digest": "d", "refers_to": None}
    whole = W.record_bytes(row)
    assert W.parse_record(gzip.compress(whole))[1] == b"abc"
    for wrong in (whole[:-1], whole.replace(b"WARC/1.1", b"HTTP/1.1"), whole.replace(b"Length: 3", b"Length: 2")):
        with pytest.raises(ValueError):
            W.parse_record(gzip.compress(wrong))
