"""Sources, sinks, streaming and alternative execution paths."""

import json
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import vocab as V
from tallyspark.operators import gates as GT
from tallyspark.operators import generate as G
from tallyspark.operators import lending_jobs as LJ
from tallyspark.sources import dims, jsonl
from tallyspark.streaming import redaction as SR


def test_prompt_list_forms(spark):
    d = Path(tempfile.mkdtemp(prefix="tally-test-"))
    (d / "a.json").write_text(json.dumps(["один", "хоёр"], ensure_ascii=False), encoding="utf-8")
    (d / "b.json").write_text(json.dumps({"prompts": ["гурав"]}, ensure_ascii=False), encoding="utf-8")
    (d / "c.json").write_text(json.dumps(["ok", "  "]), encoding="utf-8")
    assert [r.prompt for r in jsonl.read_prompt_list(spark, str(d / "a.json")).orderBy("pos").collect()] == ["один", "хоёр"]
    assert [r.prompt for r in jsonl.read_prompt_list(spark, str(d / "b.json")).collect()] == ["гурав"]
    with pytest.raises(Exception):
        jsonl.read_prompt_list(spark, str(d / "c.json")).collect()


def test_jsonl_roundtrip_and_summary(spark):
    d = tempfile.mkdtemp(prefix="tally-test-")
    recs = G.nested_metadata(G.sft_v2(spark.range(0, 30).withColumnRenamed("id", "idx")).drop("idx"),
                             keys=("domain", "source", "license_status", "allowed_usage", "contains_pii",
                                   "numeric_example", "metrics_expected"))
    jsonl.write_jsonl(recs, d)
    back = jsonl.read_jsonl(spark, d, jsonl.SFT_NESTED, with_file=True)
    assert back.count() == 30 and back.filter(F.size("messages") != 3).count() == 0
    row = jsonl.summary_row(back.select("metadata.domain"), "domain").first()
    assert row.rows == 30 and sum(row.domain_counts.values()) == 30


def test_preference_pair_gate(spark):
    df = spark.createDataFrame(
        [("Эцсийн шийдвэр хяналтын дараа гарна.", "Таны зээл заавал батална.", "why", "guaranteed approval"),
         ("no fees here", "fine text", "why", "fee"),
         ("ok", "заавал батална", None, "x")],
        "chosen string, rejected string, rationale string, compliance_category string")
    got = [r.pair_ok for r in GT.preference_pair_gate(df).collect()]
    assert got == [True, False, False]


def test_large_lexicon_join_matches_unrolled(spark):
    base = V.lexicon_rows()
    extra = [(len(base) + i, "filler", f"zzqx{i:04d}", "low", "alt") for i in range(300)]
    lex = spark.createDataFrame(base + extra, "ord int, category string, phrase string, severity string, alternative string")
    texts = spark.createDataFrame([(1, "Таны зээл заавал батална. No Fees! zzqx0007"), (2, "clean"), (3, "pre-approved, BLACKLISTED")],
                                  "k long, text string")
    texts = texts.unionByName(spark.createDataFrame([(1, "another text of key 1: zzqx0299"), (4, None), (5, ""), (3, "pre-approved, BLACKLISTED")],
                                                    "k long, text string"))
    table, unrolled = LJ.compliance_scan_table(texts, "text", lex), LJ.compliance_scan(texts, "text", base + extra)
    assert sorted(table.columns) == sorted(unrolled.columns)
    rows = lambda df: sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)
    assert [r for r in rows(table)] == [r for r in rows(unrolled.withColumn("is_safe", F.coalesce("is_safe", F.lit(True))))]
    by = {(r.k, r.text): [i.phrase for i in r.issues] for r in table.collect()}
    assert by[1, "Таны зээл заавал батална. No Fees! zzqx0007"] == ["заавал батална", "no fees", "zzqx0007"] and by[2, "clean"] == []
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_fallback_and_inference_messages(spark):
    seeds = spark.createDataFrame([("s1", "Миний зээл заавал батлагдах уу?")], "id string, prompt string")
    fb = G.fallback_records(seeds).first()
    assert fb.id == "fallback-s1" and [m.role for m in fb.messages] == ["system", "user", "assistant"]
    inf = G.inference_messages(seeds).first()
    assert inf.messages[1].content.endswith("\n\nМиний зээл заавал батлагдах уу?")
    assert inf.messages[0].content.endswith(G.FINAL_ONLY_INSTRUCTION)


def test_translation_pairs_gate(spark):
    df = spark.createDataFrame([("a", "б", "u", "CC", None, "train"), ("c", "d", "u", "", None, "train"),
                                ("e", "f", None, " ", None, "x")],
                               "source_text string, target_text string, source_url string, license_status string, "
                               "retrieval_date string, allowed_usage string")
    out = G.translation_pairs(df).collect()
    assert len(out) == 2 and out[0].metadata.license_status == "CC"  # ' ' is truthy, '' is not


def test_manifest_dimension(spark):
    m = dims.source_manifest(spark, "2025-01-01")
    assert m.count() == 12
    assert {r.category: r["count"] for r in m.groupBy("category").count().collect()} == {"general": 6, "legal": 1, "finance": 5}


def test_stream_redaction(spark):
    src = tempfile.mkdtemp(prefix="tally-src-")
    spark.createDataFrame([(1, "call 99112233 now"), (2, "mail a.b@example.com")], "id long, text string") \
        .write.mode("overwrite").parquet(src)
    import uuid
    # the stream name is its identity (checkpoint + sink); a fresh one per test run
    sink = SR.run_file_stream(spark, src, "id long, text string", "text", f"test_stream_{uuid.uuid4().hex[:8]}")
    got = {r.id: r.redacted_text for r in spark.read.parquet(sink).collect()}
    assert got == {1: "call [REDACTED_PHONE]now", 2: "mail [REDACTED_EMAIL]"}


def test_stream_query_reads_a_table_of_several_files(spark):
    import __spark_entry__ as E
    d = tempfile.mkdtemp(prefix="tally-src-")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(3).write.parquet(f"{d}/documents.parquet")
    for path in (d, "/root/testdata/sf0.001"):
        assert E.queries()["log_redaction_stream"](spark, path).count() == docs.count()


def test_stream_resumes_under_its_name(spark):
    import uuid
    src, name = tempfile.mkdtemp(prefix="tally-src-"), f"test_stream_{uuid.uuid4().hex}"
    for i in (1, 2):
        spark.createDataFrame([(i, f"call 9911223{i}")], "id long, text string").coalesce(1).write.mode("append").parquet(src)
        sink = SR.run_file_stream(spark, src, "id long, text string", "text", name)
        assert spark.read.parquet(sink).count() == i
