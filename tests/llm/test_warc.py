from __future__ import annotations

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from siltstone.llm import queries, warc
from siltstone.llm.common import shared_folder

BIG = "x" * 999 + "é"


def pages(spark):
    rows = [(k, f"http://h/{k}", BIG) for k in (3, 9, 5)] + [(1, None, None), (2, "u", ""), (4, "u\r\nX: y", "WARC/1.1\r\n\r\nnot a record\r\n\r\n")]
    rows += [(6, "u6", "y" * 999), (7, "u7", "y" * 999), (8, "u8", "z" * 2000), (8, "u8", "z" * 2000), (8, "u8", "z" * 10), (None, "n", "lost")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"id": F.lit(0), "digest": F.lit("d"), "value": F.lit("v")}).repartition(3)


def test_round_trip(spark):
    """Every row is a capture: repeated ids and null ones too."""
    rows = warc.round_trip(pages(spark)).withColumn("page", warc.page_told(F.col("metadata.block"))).collect()
    assert len(rows) == 12 and len({r.capture for r in rows}) == 12
    assert all(warc_id.endswith(f":{r.capture.split(':', 3)[3]}") for r in rows for warc_id in (r.request.record_id, r.metadata.record_id))
    found = {k: [r for r in rows if r.page == k] for k in {r.page for r in rows}}
    for k, html in ((1, ""), (2, ""), (4, "WARC/1.1\r\n\r\nnot a record\r\n\r\n"), (6, "y" * 999), (7, "y" * 999), (9, BIG), (None, "lost")):
        (row,) = found[k]
        assert row.response.record_type == "response"
        assert bytes(row.response.block).decode() == html
        assert row.response.digest == row.response.block_sha1 == hashlib.sha1(html.encode()).hexdigest()
        assert row.response.http_length == row.response.block_bytes == len(html.encode())
    assert sorted((r.response.record_type, r.response.http_length) for r in found[8]) == [("response", 10), ("response", 2000), ("response", 2000)]
    (holder,) = found[9]
    for k in (3, 5):
        (row,) = found[k]
        assert (row.response.record_type, row.response.refers_to) == ("revisit", holder.capture)
        assert (row.response.http_length, row.response.block_bytes) == (len(BIG.encode()), 0)
        assert row.response.digest == hashlib.sha1(BIG.encode()).hexdigest()
    assert bytes(found[3][0].request.block).startswith(b"GET http://h/3 HTTP/1.1\r\n")
    assert bytes(found[9][0].metadata.block) == b"page: 9\r\n"


def test_query_equals_its_sql_on_odd_ids(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    pages(spark).coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    df = queries.warc_query(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(f"select {', '.join(df.columns)} from ({queries.WARC_SQL})").fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_query_joins_the_records_of_a_capture(spark, tmp_path):
    pages(spark).filter("page_id in (1, 2, 3)").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    plan = queries.warc_query(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan


def test_archives_are_plain_warc(spark, monkeypatch):
    """Files of few records, of one gzip member or several, read in pieces of any size."""
    monkeypatch.setattr(warc, "RECORDS_A_FILE", 5)
    path = f"{shared_folder(spark)}/archives"
    warc.write_archives(warc.captures(pages(spark), "page_id", "url", "html"), path)
    files = [bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    assert len(files) >= 8
    data = b"".join(gzip.decompress(f) for f in files)
    records = list(warc.parse(iter([data])))
    assert len(records) == 36
    assert {r[1] for r in records} == {"request", "response", "revisit", "metadata"}
    assert data.endswith(b"\r\n\r\n")
    whole = b"".join(files)
    for size in (1, 7, 1000):
        monkeypatch.setattr(warc, "_CHUNK", size)
        assert list(warc.parse(warc.unpacked(memoryview(whole)))) == records
    with pytest.raises(ValueError, match="ends within"):
        list(warc.parse(iter([data[:-300]])))


def test_long_payload(spark):
    html = "<p>" + "é\r\n\r\nWARC/1.1 " * 400_000
    df = spark.createDataFrame([(1, "u", html), (2, "v", html)], "page_id long, url string, html string")
    found = {r.page: r for r in warc.round_trip(df).withColumn("page", warc.page_told(F.col("metadata.block"))).collect()}
    assert bytes(found[2].response.block).decode() == html
    assert (found[1].response.record_type, found[1].response.http_length) == ("revisit", len(html.encode()))


def test_empty_table(spark):
    assert warc.round_trip(pages(spark).limit(0)).count() == 0
