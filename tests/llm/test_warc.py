"""Archives written and read back."""

import gzip
import hashlib

from pyspark.sql import functions as F

from sluice.llm.warc import read_plan, read_records, write_archives

ROWS = [
    (1, "http://a/x", "é" * 60),
    (2, "http://a/y", "é" * 60),
    (3, None, "é" * 60),
    (4, "http://b/", "short"),
    (5, "http://b/?q=1", "short"),
    (6, "", None),
    (7, "http://c/\r\nx", ""),
    (None, "http://d/", "é" * 60),
    (8, "http://e/", "long text\r\n\r\nWARC/1.1\r\n" * 40000),
    (2, "http://a/y", "é" * 60),
]


def test_round_trip(table, tmp_path):
    folder = f"file://{tmp_path}/w"
    df = table([(*r, "x") for r in ROWS], "page_id long, url string, html string, payload string")
    index = write_archives(df, folder, archive_bytes=1000)
    back = read_records(index, folder).collect()
    assert len(back) == len(ROWS)
    by_page = {r["page_id"]: r for r in back}
    for page, _url, html in ROWS:
        r, payload = by_page[page], (html or "").encode()
        assert r["payload_bytes"] == len(payload)
        assert r["payload_digest"] == hashlib.sha256(payload).hexdigest()
        copy = page in (2, 3, None)
        assert (r["record_type"], r["refers_to"]) == (("revisit", 1) if copy else ("response", None))
        assert r["payload"] is None if copy else bytes(r["payload"]) == payload
    assert by_page[1]["url"] == "http://a/x" and by_page[3]["url"] is None


def test_archives_are_plain_warc_files(table, tmp_path):
    index = write_archives(table(ROWS[:6], "page_id long, url string, html string"), f"{tmp_path}/w").collect()
    files = sorted(tmp_path.glob("w/*.warc.gz"))
    assert len(files) == 1 and not list(tmp_path.glob("w/*.gz.*"))
    raw = files[0].read_bytes()
    assert sorted((r["offset"], r["length"]) for r in index)[0][0] == 0
    assert sum(r["length"] for r in index) == len(raw)
    for r in index:
        member = gzip.decompress(raw[r["offset"] : r["offset"] + r["length"]])
        assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")
        assert (b"WARC-Type: " + r["record_type"].encode()) in member
    assert gzip.decompress(raw).count(b"WARC-Record-ID") == 6


def test_selected_records_only(table, tmp_path):
    index = write_archives(table(ROWS[:7], "page_id long, url string, html string"), f"{tmp_path}/w")
    back = read_records(index.filter(F.col("page_id") % 2 == 0), f"{tmp_path}/w", gap=0)
    assert sorted(r["page_id"] for r in back.collect()) == [2, 4, 6]


def test_read_plan():
    import numpy as np

    offset, length = np.array([0, 10, 20, 100, 1000]), np.array([10, 10, 10, 5, 7])
    assert read_plan(offset, length, gap=0, most=100) == [(0, 3), (3, 4), (4, 5)]
    assert read_plan(offset, length, gap=70, most=1000) == [(0, 4), (4, 5)]
    assert read_plan(offset, length, gap=10**6, most=20) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert read_plan(offset[:0], length[:0], 1, 1) == []


def test_empty_table(table, tmp_path):
    index = write_archives(table([], "page_id long, url string, html string"), f"{tmp_path}/w")
    assert index.collect() == [] and read_records(index, f"{tmp_path}/w").collect() == []
