"""Work over many rows: even tasks, facts of texts by Arrow batches, and what may not grow with the rows."""

import glob
import random
import re
import time

import pyarrow as pa
from pyspark.sql import functions as F

from tallyspark.functions import lending as L
from tallyspark.functions import patterns as P
from tallyspark.functions import scan as SC
from tallyspark.operators import corpus
from tallyspark.operators import gates as GT
from tallyspark.operators import quality as Q
from tallyspark.operators import templates_v3 as T3
from tallyspark.plans import files, registry
from tallyspark.session import ensure_checkpoint_dir
from tallyspark.sources import lines as LN
from tallyspark.streaming import fanout as FO

ODD = ["", None, "a", "Ж", "Ёё Өө Үү K İ", "😀я\n z", "Өрийн ДАРАМТЫН харьцаа 51.7%", "x" * 70000, "я" * 70000, "<Think> Зөвлөмж"]


def orders(spark, path, n):
    spark.range(n).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), (F.col("id") * 1000.0).alias("o_totalprice")) \
        .coalesce(1).write.parquet(f"{path}/orders.parquet")
    return str(path)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_task_of_generated_records_is_bounded(spark, tmp_path):
    made = registry.generated(spark, orders(spark, tmp_path, 400_000), "v1").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in made.collect()) <= 55_000


def test_letters_and_phrases_as_python_finds_them(spark):
    texts = pa.array([None, *ODD, "Ө" * 3])[1:]
    for table, classes in ((SC.LETTERS, (P.MN_LETTER_CHARS, P.LATIN_CHARS)), (SC.SHARE, (P.MN_SHARE_CHARS,))):
        for got, chars in zip(SC.class_counts(texts, table, len(classes)), classes):
            assert got.tolist() == [sum(c in chars for c in t or "") for t in texts.to_pylist()]
    low, verbatim = ["дарамтын", "reason", "ё"], ["Зөвлөмж", "харьцаа"]
    df = spark.createDataFrame([(i, t, v) for i, (t, v) in enumerate(zip(ODD, ["", "a", None, "Ж", "x", "я", "51.7%", "xx", "x", "я"]))], "i int, t string, v string")
    for r in df.withColumn("f", SC.facts(F.col("t"), low, verbatim, [F.col("v")])).collect():
        if r.t is None:
            assert r.f is None
            continue
        bits = lambda held: sum(1 << i for i, h in enumerate(held) if h)
        assert (r.f.low, r.f.verbatim, r.f["values"]) == (
            bits(p in r.t.lower() for p in low), bits(p in r.t for p in verbatim), bits([r.v is not None and r.v in r.t]))


def test_the_gate_of_a_text_runs_no_scan_a_phrase(spark):
    cols = "gidx long, domain string, source string, contains_pii boolean, user string, assistant string, numeric_example boolean"
    rows = [(i, "credit_memo_numeric", T3.SOURCE, False, "ОРЛОГО 10 сая, зардал 5 сая" if i else None, t, True) for i, t in enumerate(ODD)]
    checked = Q.v3_violations(spark.createDataFrame(rows, cols))
    assert plan(checked).count("lower(") == 0 and plan(checked).count("translate(") == 0
    got = {r.gidx: r for r in checked.collect()}
    assert got[0].mn_chars == 0 and got[1].mn_chars is None and got[9].first_violation == "thinking tag found"
    assert "missing numeric field in prompt: debt" in got[2].violations and "missing numeric field in prompt: revenue" in got[0].violations


def test_a_text_of_a_pair_is_lowered_once(spark):
    df = spark.createDataFrame([("Та", "Guaranteed APPROVAL", "r", "c"), (None, None, "r", "c")], "chosen string, rejected string, rationale string, compliance_category string")
    gated = GT.preference_pair_gate(df)
    assert plan(gated).count("lower(") == 2
    assert [r.pair_ok for r in gated.collect()][0]


def test_shares_are_counted_without_translate(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, text string")
    gated = corpus.clean_and_gate(df)
    assert "translate(" not in plan(gated)
    for r in gated.collect():
        clean = " ".join(r.text.split()) if r.text is not None else None
        assert r.clean_text == clean
        assert r.mn_share is None if clean is None else abs(r.mn_share - sum(c in P.MN_SHARE_CHARS for c in clean) / max(len(clean), 1)) < 1e-9


def test_numbers_are_tried_once(spark):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(["1", "20", " ", ",", ".", "сая", "төгрөг", "зээл", "loan", "сар", "жил", "\n", "x" * 9, "million"]) for _ in range(rnd.randint(1, 25))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for new in (P.loan_context_java(), P.term_java()):
        old = new.replace("(?<!\\d)", "").replace("]*+)", "]*)").replace("\\d++", "\\d+")
        assert old != new
        pairs = [(F.regexp_extract("t", old, g), F.regexp_extract("t", new, g)) for g in range(3)]
        same = df.filter(~(F.array(*[a for a, _ in pairs]) == F.array(*[b for _, b in pairs])))
        assert same.count() == 0
    began = time.time()
    assert spark.createDataFrame([("1" * 9000,)], "t string").select(L.context_match("t").alias("m")).first().m == ""
    assert time.time() - began < 15


def test_a_batch_of_one_file_goes_to_many_tasks(spark, tmp_path):
    spark.range(120_000).withColumn("text", F.lit("x")).coalesce(1).write.parquet(str(tmp_path / "in"))
    seen = []
    FO.write_batch(spark.read.parquet(str(tmp_path / "in")), 0, str(tmp_path / "out"), {"x": lambda m: (seen.append(m.rdd.getNumPartitions()), m)[1]})
    assert seen[0] >= 3 and spark.read.parquet(str(tmp_path / "out" / "x")).count() == 120_000


def test_splits_grow_with_the_files(spark, tmp_path):
    (tmp_path / "file=00").mkdir()
    (tmp_path / "file=00" / "part.txt").write_bytes(b"x" * 100_000)
    cores = spark.sparkContext.defaultParallelism
    assert LN.split_size(spark, str(tmp_path), 64, 1) == 100_000 // cores and LN.split_size(spark, str(tmp_path), 1 << 20) == 1 << 20


def test_sets_for_the_first_failure_are_compressed_and_sorted(spark, tmp_path):
    files.quality_v3_first_failure(spark, orders(spark, tmp_path, 400)).collect()
    for name in files.FAIL_SETS:
        found = glob.glob(f"{ensure_checkpoint_dir(spark)}/failfast-{name}/*/file=*/*")
        assert found and all(f.endswith(".gz") for f in found)
        last = max({f.split("/failfast-")[1].split("/")[1] for f in found}, key=lambda u: max(found, key=lambda f: u in f))
        for f in (f for f in found if last in f):
            keys = [int(re.search(r'"gidx":(\d+)', r.value).group(1)) for r in spark.read.text(f).collect() if "gidx" in r.value]
            assert keys == sorted(keys)
