import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from footfall.llm import warc
from footfall.llm.queries import op4_warc
from footfall.llm.warc import WarcParams, coalesced

SCHEMA = "page_id long, url string, html string"
PAGES = [
    (1, "http://a.example/x y\n?q=%zz", "é" * 60),
    (2, None, "é" * 60),
    (3, "http://b.example/", "short"),
    (4, "http://b.example/", "short"),
    (5, "http://c.example/", None),
    (6, "http://d.example/", "line\r\n\r\nWARC/1.1\r\n" * 20),
    (7, "http://e.example/", "x" * 300_000),
    (0, "http://f.example/", "é" * 60),
    (8, "http://g.example/", "z" * 100),
    (8, "http://g.example/", "z" * 100),
]


def _rows(spark, pages, params=WarcParams()):
    table = spark.createDataFrame(pages, SCHEMA).withColumn("payload", F.lit("own")).repartition(3)
    folder, index = warc.write_archives(table, params)
    return folder, index, warc.read_records(folder, index, params).collect()


@pytest.mark.parametrize("params", [WarcParams(), WarcParams(archive_bytes=2000, max_read=1, max_gap=0)])
def test_round_trip(spark, params):
    folder, index, rows = _rows(spark, PAGES, params)
    assert sorted(r.page_id for r in rows) == sorted(p[0] for p in PAGES)
    html = {p[0]: p[2] or "" for p in PAGES}
    for r in rows:
        whole = html[r.page_id].encode()
        assert r.digest == hashlib.sha256(whole).hexdigest()
        assert bytes(r.payload) == (whole if r.record_type == "response" else b"")
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in rows}
    assert kinds == {(1, "revisit", 0), (2, "revisit", 0)} | {(i, "response", None) for i in (0, 3, 4, 5, 6, 7, 8)}
    assert next(r.uri for r in rows if r.page_id == 1) == "http://a.example/x%20y%0A?q=%25zz"


def test_archives_are_what_the_index_says(spark):
    folder, index, _ = _rows(spark, PAGES, WarcParams(archive_bytes=300))
    files = {p.name: p.read_bytes() for p in Path(folder.removeprefix("file:")).glob("*.warc.gz")}
    rows = index.collect()
    for r in rows:
        raw = gzip.decompress(files[r.archive][r.offset : r.offset + r.length])
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
        assert f"sha256:{r.digest}".encode() in raw
    assert sum(r.length for r in rows) == sum(map(len, files.values()))
    assert len(files) > 3


def test_null_and_large_ids(spark):
    _, _, rows = _rows(spark, [(None, "u", "x" * 200), (2**60 + 1, "u", "x" * 200)])
    assert {(r.page_id, r.record_type, r.refers_to) for r in rows} == {
        (None, "revisit", 2**60 + 1), (2**60 + 1, "response", None)}


def test_the_query_keeps_pages_without_id_and_tells_payloads_of_one_id_apart(spark, tmp_path):
    pages = [(None, "u", "only"), (None, "u", "x" * 200), (5, "u", "x" * 200), (7, "u", "one"), (7, "u", "two")]
    spark.createDataFrame(pages, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in op4_warc(spark, str(tmp_path)).collect()]
    sha = {t: hashlib.sha256(t.encode()).hexdigest() for t in ("only", "one", "two", "x" * 200)}
    assert sorted(rows, key=str) == sorted(
        [
            (None, 4, sha["only"], "response", None), (None, 200, sha["x" * 200], "revisit", 5),
            (5, 200, sha["x" * 200], "response", None), (7, 3, sha["one"], "response", None), (7, 3, sha["two"], "response", None),
        ],
        key=str,
    )


def test_selected_records_only(spark):
    folder, index, _ = _rows(spark, PAGES)
    some = warc.read_records(folder, index.where("page_id in (3, 7)")).collect()
    assert sorted((r.page_id, len(r.payload)) for r in some) == [(3, 5), (7, 300_000)]


def test_ranges():
    ranges = [(0, 10), (10, 5), (20, 5), (100, 10), (110, 50)]
    assert coalesced(ranges, 5, 1000) == [[0, 1, 2], [3, 4]]
    assert coalesced(ranges, 1000, 30) == [[0, 1, 2], [3], [4]]
    assert coalesced([], 5, 5) == []


def test_empty_table(spark):
    _, index, rows = _rows(spark, [])
    assert rows == [] and index.collect() == []
