import base64
import hashlib

import pytest

from tallyspark.llm import warc
from tallyspark.llm.common import fresh_path

SCHEMA = "page_id long, url string, html string, payload_bytes int"


def pages():
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:tallyspark:page:777>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    texts = {1: "plain", 2: None, 3: "", 4: inner, 5: "a WARC/1.1\r\n b" + inner * 3 + "tail", 6: "WARC/1.1\r\n", 7: "plain",
             8: "é" * 5000, 9: "plain", 10: inner, 11: "WARC/1.1\r\nContent-Length: 99999\r\n\r\nx", 12: "\r\n\r\n" * 9,
             13: "WARC/1.1\r\n" * 50}
    rows = [(k, f"http://a/{k}\r\nX: y", v, k) for k, v in texts.items()]
    return rows + [(100 + i, None, f"page {i} " * (i % 40), None) for i in range(300)] + [(9, "u", "plain", 0)]


def expected(rows, min_bytes=0):
    first = {}
    for k, _, html, _ in rows:
        first[html or ""] = max(first.get(html or "", k), k)
    out = []
    for k, _, html, _ in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = first[html or ""] != k and len(data) >= min_bytes
        out.append((k, len(data), digest, "revisit" if again else "response", first[html or ""] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split,block,min_bytes", [("128m", warc.BLOCK, 0), ("700", 900, 6)])
def test_round_trip_with_magic_in_payloads(spark, split, block, min_bytes):
    rows, path = pages(), fresh_path(spark, "test-warc")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    warc.write_warc(spark, df, path, min_bytes=min_bytes)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got = warc.resolved(spark, warc.read_warc(spark, path, block=block)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert all(r.complete for r in got)
    assert sorted([tuple(r)[:5] for r in got], key=str) == expected(rows, min_bytes)


def test_payloads_that_look_like_records_give_candidates_off_the_chain(spark):
    path = fresh_path(spark, "test-warc")
    warc.write_warc(spark, spark.createDataFrame(pages()[:13], SCHEMA).coalesce(1), path)
    found = warc.candidates(spark, path)
    real = warc.reachable(spark, found)
    assert found.count() > 60 and real.count() == 13
    assert found.where("record_id = '<urn:tallyspark:page:777>'").join(real, ["file", "offset"]).count() == 0


def test_broken_chain_and_empty_table(spark):
    path = fresh_path(spark, "test-warc")
    warc.write_warc(spark, spark.createDataFrame([], SCHEMA), path)
    assert warc.read_warc(spark, path).count() == 0
    text = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nabc"
    path = fresh_path(spark, "test-warc")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    got = warc.read_warc(spark, path).orderBy("offset").collect()
    assert [r.complete for r in got] == [True, False] and got[0].payload_bytes == 3


def test_null_id(spark):
    path = fresh_path(spark, "test-warc")
    warc.write_warc(spark, spark.createDataFrame([(None, "u", "same", 1), (4, "u", "same", 1)], SCHEMA), path)
    got = {r.page_id: tuple(r) for r in warc.resolved(spark, warc.read_warc(spark, path)).collect()}
    assert got[4][3:5] == ("response", None) and got[None][3:5] == ("revisit", 4) and got[None][1] == 4
