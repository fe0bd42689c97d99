"""Line numbers, fail-fast checks and the jobs that write and read files, against plain Python on small files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import fail_fast as FF
from tallyspark.sources import lines as LN


def written(tmp_path, name, text):
    (tmp_path / name).write_bytes(text.encode())
    return tmp_path / name


@pytest.mark.parametrize("split", [None, 50, 1000])
def test_line_numbers_at_any_split_size(spark, tmp_path, split):
    rnd = random.Random(split)
    want = set()
    for name in ("a.jsonl", "b.jsonl", "c.jsonl"):
        ends = {"a.jsonl": ["\n"], "b.jsonl": ["\r\n"], "c.jsonl": ["\n", "\r\n"]}[name]
        body = "".join(rnd.choice(["", " ", "x" * rnd.randint(1, 300), "é я"]) + rnd.choice(ends) for _ in range(400)) + "the last, without an end"
        written(tmp_path, name, body)
        with open(tmp_path / name, encoding="utf-8") as f:
            want |= {(name, i, line.rstrip("\n")) for i, line in enumerate(f, 1)}
    written(tmp_path, "empty.jsonl", "")
    got = LN.numbered_lines(spark, str(tmp_path), split)
    assert {(r.file.rsplit("/", 1)[1], r.line, r.value) for r in got.collect()} == want


def test_records_blank_lines_and_bad_lines(spark, tmp_path):
    good = [json.dumps({"id": i, "name": f"n{i}"}) for i in range(50)]
    path = written(tmp_path, "r.jsonl", "\n\n".join(good) + "\n")
    got = LN.read_jsonl_lines(spark, str(path), "id long, name string", 64).collect()
    assert {(r.line, r.id, r.name) for r in got} == {(2 * i + 1, i, f"n{i}") for i in range(50)}
    path = written(tmp_path, "bad.jsonl", good[0] + "\n\n{not json\n" + good[1])
    with pytest.raises(Exception, match=r"bad.jsonl:3: not a JSON record"):
        LN.read_jsonl_lines(spark, str(path), "id long, name string").select(F.count("line")).collect()
    kept = LN.read_jsonl_lines(spark, str(path), "id long, name string", strict=False).collect()
    assert [(r.line, r.id, r.malformed) for r in sorted(kept, key=lambda r: r.line)] == [(1, 0, False), (3, None, True), (4, 1, False)]


def gate(records):
    return records.withColumn("first_violation", F.when(F.col("n") < 0, "n is negative").when(F.col("n").isNull(), "n is missing"))


def made(tmp_path, name, rows):
    (tmp_path / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))


def test_first_failure_in_order_of_file_and_line(spark, tmp_path):
    ok = [{"n": i, "domain": "d" + str(i % 2), "source": "s"} for i in range(10)]
    for i in range(8):
        made(tmp_path, f"f{i}.jsonl", ["", *ok])
    schema = "n long, domain string, source string"
    clean = FF.first_failure(spark, str(tmp_path), schema, gate).first()
    assert (clean.status, clean.message, clean.rows, clean.domains, clean.files_read) == ("PASS", None, 80, {"d0": 40, "d1": 40}, 8)
    made(tmp_path, "f6.jsonl", [*ok, {"n": -1}])
    late = FF.first_failure(spark, str(tmp_path), schema, gate).first()
    assert late.message.endswith("f6.jsonl:11: n is negative") and late.files_read == 8
    made(tmp_path, "f3.jsonl", ["", *ok, "", {"n": -5, "domain": "z"}, {"domain": "a"}, "{broken"])
    early = FF.first_failure(spark, str(tmp_path), schema, gate).first()
    assert early.message.startswith("FAIL file:") and early.message.endswith("f3.jsonl:13: n is negative") and early.line == 13
    assert early.files_read == 5 < clean.files_read
    made(tmp_path, "f0.jsonl", ["{broken"])
    assert FF.first_failure(spark, str(tmp_path), schema, gate).first().message.endswith("f0.jsonl:1: not a JSON record of the schema")


def test_first_failure_of_counts_and_empty_sets(spark, tmp_path):
    made(tmp_path, "f.jsonl", [{"n": 1, "domain": "a", "source": "s"}])
    schema = "n long, domain string, source string"
    short = FF.first_failure(spark, str(tmp_path), schema, gate, lambda n: {"a": 1, "b": 1} if n == 1 else None).first()
    assert short.status == "FAIL" and "domain counts mismatch. got={'a': 1} expected={'a': 1, 'b': 1}" in short.message
    made(tmp_path, "f.jsonl", ["", " "])
    assert FF.first_failure(spark, str(tmp_path), schema, gate).first().message.endswith("empty dataset")
