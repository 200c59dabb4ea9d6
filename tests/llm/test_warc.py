import gzip
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from hexloom.llm import warc
from hexloom.llm.common import fresh_dir
from hexloom.llm.warc import read_warc, write_warc

BIG = "é" * 700  # 1400 bytes
ROWS = [
    (1, "http://a/1", BIG, "x"), (2, "http://a/2 \n", BIG, "x"), (9, None, BIG, "x"), (9, None, BIG, "x"), (3, "http://a/3", "small", "x"), (4, "http://a/4", "small", "x"),
    (5, "http://a/5", None, "x"), (6, "http://a/6", "", "x"), (7, "http://b/7", "<p>" + "long " * 300_000, "x"), (None, "http://b/8", BIG, "x"), (10, "http://b/10", "a" * 999 , "x"), (11, "http://b/11", "a" * 999, "x"),
]
SCHEMA = "page_id long, url string, html string, digest string"


@pytest.mark.parametrize("broadcast", [32 << 20, 0])
def test_round_trip(spark, monkeypatch, broadcast):
    monkeypatch.setattr(warc, "BROADCAST_BYTES", broadcast)
    path = fresh_dir(spark, "warc")
    assert write_warc(spark.createDataFrame(ROWS, SCHEMA).repartition(3), path) == len(ROWS)
    got = read_warc(spark, path).toPandas()
    assert len(got) == len(ROWS)
    by = {}
    for r in got.itertuples():
        by.setdefault(r.record_id, []).append(r)
    assert {r.record_type for r in by["urn:x-row:9"]} == {"response"} and len(by["urn:x-row:9"]) == 2
    for k in (1, 2):
        (r,) = by[f"urn:x-row:{k}"]
        assert (r.record_type, r.refers_to, r.payload, r.payload_length) == ("revisit", "urn:x-row:9", b"", 1400)
        assert r.payload_digest == hashlib.sha1(BIG.encode()).hexdigest()
    assert by["urn:x-row:2"][0].target_uri == "http://a/2%20%0A"
    for k, html in ((3, "small"), (4, "small"), (5, ""), (6, ""), (7, ROWS[8][2]), (10, "a" * 999), (11, "a" * 999)):
        (r,) = by[f"urn:x-row:{k}"]
        assert (r.record_type, r.payload.decode(), r.payload_length) == ("response", html, len(html.encode()))
    assert sum(r.record_id.startswith("urn:uuid:") and r.payload == BIG.encode() for r in got.itertuples()) == 1


def test_members_are_plain_gzip(spark):
    path = fresh_dir(spark, "warc")
    write_warc(spark.createDataFrame(ROWS[:4], SCHEMA).coalesce(1), path)
    from hexloom.llm.warc import filesystem

    fs, base = filesystem(path)
    data = gzip.decompress(fs.open_input_file(base + "/part-00000.warc.gz").readall()) if fs.get_file_info(base + "/part-00000.warc.gz").is_file else b"".join(
        gzip.decompress(fs.open_input_file(x.path).readall()) for x in fs.get_file_info(__import__("pyarrow").fs.FileSelector(base)))
    assert data.count(b"WARC/1.1\r\n") == 4 and data.endswith(b"\r\n\r\n")
    plain = fresh_dir(spark, "plain")
    fs.create_dir(filesystem(plain)[1])
    with fs.open_output_stream(filesystem(plain)[1] + "/a.warc") as out:
        out.write(data)
    with fs.open_output_stream(filesystem(plain)[1] + "/b.warc.gz", compression=None) as out:  # members without a length
        out.write(b"".join(gzip.compress(b"WARC/1.1\r\n" + x) for x in data.split(b"WARC/1.1\r\n")[1:]))
    assert read_warc(spark, plain).count() == 8
    assert read_warc(spark, plain, "payload binary").where(F.octet_length("payload") == 1400).count() == 4


def test_filters_are_pushed(spark):
    path = fresh_dir(spark, "warc")
    write_warc(spark.createDataFrame(ROWS, SCHEMA), path)
    df = read_warc(spark, path, "record_type string, target_uri string").where("record_type = 'revisit' and target_uri like 'http://a/%'")
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\bFilter\b", plan)
    assert read_warc(spark, path).where("content_length > 1000000 or record_type = 'none'").count() == 1


def test_empty(spark):
    path = fresh_dir(spark, "warc")
    assert write_warc(spark.createDataFrame(ROWS, SCHEMA).where(F.lit(False)), path) == 0
    assert read_warc(spark, path).count() == 0


def test_query_with_null_ids(spark, tmp_path):
    from hexloom.llm.queries import op8_warc

    rows = [(None, "u", BIG), (None, None, "small"), (3, "u", BIG), (4, None, BIG), (5, "u", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in op8_warc(spark, str(tmp_path)).collect()), key=str)
    assert got == [(0, 1400, "response", None), (0, 5, "response", None), (3, 1400, "revisit", 4), (4, 1400, "response", None), (5, 0, "response", None)]
