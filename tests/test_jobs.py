"""Stored results, preparation, partitioned sets, row glossaries, equality of sets, totals and the stream's outputs."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import vocab as V
from tallyspark.operators import compare_sets as CS
from tallyspark.operators import credit_jobs as CJ
from tallyspark.operators import lending_jobs as LJ
from tallyspark.operators import prepare as PR
from tallyspark.operators import quality as Q
from tallyspark.operators import result_store as RS
from tallyspark.sources import jsonl as JS
from tallyspark.streaming import fanout as FO


# --- X4 -------------------------------------------------------------------------------------------------------------------

def test_store_computes_each_payload_once(spark, tmp_path):
    store = RS.ResultStore(spark, str(tmp_path / "store"), "string")
    texts = ["a", "b", "a", None, "", "c"]
    df = lambda ts: spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "k long, text string")
    made = lambda c: F.concat(c, F.lit("!"))
    got, n = store.get_or_compute(df(texts), "p", "text", made, "out")
    assert n == 4 and [r.out for r in got.orderBy("k").collect()] == ["a!", "b!", "a!", None, "!", "c!"]
    other = lambda c: F.concat(c, F.lit("?"))  # noqa: E731  would show where it ran
    got, n = store.get_or_compute(df(texts), "p", "text", other, "out")
    assert n == 0 and len(store.batches()) == 1 and [r.out for r in got.orderBy("k").collect()][:3] == ["a!", "b!", "a!"]
    again = RS.ResultStore(spark, str(tmp_path / "store"), "string")  # another session of work
    got, n = again.get_or_compute(df([*texts, "d", "d"]), "p", "text", other, "out")
    assert n == 1 and [r.out for r in got.orderBy("k").collect()] == ["a!", "b!", "a!", None, "!", "c!", "d?", "d?"]
    _, n = again.get_or_compute(df(["a"]), "q", "text", made, "out")  # another kind of result
    assert n == 1


def test_store_without_a_commit_record_counts_nothing_and_doubles_count_once(spark, tmp_path):
    store = RS.ResultStore(spark, str(tmp_path / "s"), "string")
    rows = spark.createDataFrame([("k", "1")], "cache_key string, result string")
    rows.write.parquet(str(tmp_path / "s" / "batches" / "000000-died"))
    assert store.results().count() == 0
    assert store.add(rows) == 1 and store.add(rows.withColumn("result", F.lit("2"))) == 1
    assert [(r.cache_key, r.result) for r in store.results().collect()] == [("k", "1")]
    assert store.get_or_compute(spark.createDataFrame([], "text string"), "p", "text", F.upper, "out")[0].collect() == []


# --- A8, S4 ---------------------------------------------------------------------------------------------------------------

def record(i, pii=False, bad=False):
    return (i, [("user", f"q{i}"), ("robot" if bad else "assistant", "a")], pii)


SCHEMA = "id long, messages array<struct<role:string,content:string>>, contains_pii boolean"


def members(path):
    out = {}
    for split in ("train", "val"):
        out[split] = sorted(json.loads(x)["id"] for f in (path / f"split={split}").glob("*.json") for x in f.read_text().splitlines())
    return out


def test_preparation_counts_equal_the_files(spark, tmp_path):
    rows = [record(i, pii=i % 10 == 3, bad=i % 10 == 7) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    s = PR.prepare_sft(spark, df, str(tmp_path / "p")).first()
    assert (s.accepted, s.rejected_contains_pii, s.quarantined, s.guard) == (160, 20, 20, "ok")
    found = members(tmp_path / "p")
    assert (s.train, s.validation) == (len(found["train"]), len(found["val"])) == (144, 16)
    assert sorted(found["train"] + found["val"]) == [i for i in range(200) if i % 10 not in (3, 7)]
    again = PR.prepare_sft(spark, df.repartition(2), str(tmp_path / "q")).first()
    assert members(tmp_path / "q") == found and again.train == s.train
    dry = PR.prepare_sft(spark, df, str(tmp_path / "dry"), dry_run=True).first()
    assert (dry.train, dry.validation) == (144, 16) and not (tmp_path / "dry").exists()
    with_pii = PR.prepare_sft(spark, df, str(tmp_path / "r"), allow_pii=True, seed=7).first()
    assert (with_pii.accepted, with_pii.rejected_contains_pii) == (180, 0) and members(tmp_path / "r")["val"] != found["val"]


def test_preparation_of_small_and_empty_sets(spark, tmp_path):
    few = spark.createDataFrame([record(0), record(1)], SCHEMA)
    assert PR.prepare_sft(spark, few, str(tmp_path / "a")).first().guard == "error: dataset too small" and not (tmp_path / "a").exists()
    s = PR.prepare_sft(spark, few, str(tmp_path / "b"), allow_small=True).first()
    assert (s.train, s.validation) == (1, 1)
    one = PR.prepare_sft(spark, few.limit(1), str(tmp_path / "c"), allow_small=True).first()
    assert (one.train, one.validation) == (1, 0)
    none = PR.prepare_sft(spark, spark.createDataFrame([], SCHEMA), str(tmp_path / "d"), allow_small=True).first()
    assert none.guard == "error: no records accepted" and not (tmp_path / "d").exists()


def test_rerun_replaces_its_folders_only_and_reads_are_pruned(spark, tmp_path):
    path = str(tmp_path / "set")
    df = spark.createDataFrame([(i, "ab"[i % 2], f"d{i % 3}", "x") for i in range(30)], "id long, split string, domain string, text string")
    JS.write_jsonl_partitioned(df, path, ["split", "domain"])
    JS.write_jsonl_partitioned(df.filter("split = 'a' AND domain = 'd0' AND id < 7").withColumn("text", F.lit("y")), path, ["split", "domain"])
    back = JS.read_jsonl_partitioned(spark, path, "id long, text string", "split string, domain string")
    rows = {r.id: r for r in back.collect()}
    assert sorted(rows) == [i for i in range(30) if not (i % 6 == 0 and i >= 7)] and {i for i, r in rows.items() if r.text == "y"} == {0, 6}
    plan = back.filter("split = 'a' AND domain = 'd1'")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]  # folders that don't match aren't opened
    assert "split" in filters and "domain" in filters


# --- T9, S6 ----------------------------------------------------------------------------------------------------------------

def glossary_brute(text, entries):
    low = (text or "").lower()
    used = sorted({p for s, p in entries if s.lower() in low or p.lower() in low})
    return used, [V.GLOSSARY_WARNING.format(preferred=p, source=s) for s, p in entries if s.lower() in low and p.lower() not in low]


@pytest.mark.parametrize("most", [200_000, 0])
def test_glossary_by_row(spark, most):
    own = {"a": {"loan": "credit", "Car": "auto"}, "b": {"zebra": "horse", "fee": "fee"}, "": {"x": "y"}}
    rows = [(g, i, t, p) for g, d in own.items() for i, (t, p) in enumerate(d.items())]
    table = spark.createDataFrame(rows, "glossary_id string, ord int, term string, preferred string")
    texts = ["A loan for a CAR", "credit and auto", "zebra fee", None, "", "x y зээл", "Loan! interest rate"]
    asked = [(f"{i}-{g}", t, g) for i, t in enumerate(texts) for g in ("a", "b", "", "none", None)]
    df = spark.createDataFrame(asked, "k string, text string, glossary_id string")
    got = {r.k: r for r in LJ.glossary_by_row(df, "text", table, broadcast_entries=most).collect()}
    assert len(got) == len(asked)
    for k, text, g in asked:
        entries = list({**dict(V.DEFAULT_GLOSSARY), **own.get(g, {})}.items())
        assert (got[k].terms_used, got[k].glossary_warnings) == glossary_brute(text, entries), k


# --- equality of sets, totals ------------------------------------------------------------------------------------------------

def test_set_difference_counts_copies(spark):
    a = [("x", 1), ("x", 1), ("y", None), ("z", 3)]
    b = [("x", 1), ("y", None), ("y", None), ("w", 0), ("w", 0)]
    left, right = (spark.createDataFrame(r, "side string, k int") for r in (a, b))
    names = {"side": "name"}
    left, right = left.withColumnsRenamed(names), right.withColumnsRenamed(names).select("k", "name")
    got = {(r.name, r.k, r.side): r.n for r in CS.set_difference(left, right).collect()}
    want = {(*r, "missing"): n for r, n in (Counter(a) - Counter(b)).items()} | {(*r, "surplus"): n for r, n in (Counter(b) - Counter(a)).items()}
    assert got == want
    rows = {r.name: r for r in CS.equality({"p": (left, right), "same": (left, left.repartition(3)), "none": (left.limit(0), right.limit(0))}).collect()}
    assert (rows["p"].missing, rows["p"].surplus, rows["p"].equal) == (2, 3, False) and rows["same"].equal and rows["none"].equal
    with pytest.raises(ValueError):
        CS.set_difference(left, right.drop("k"))


def test_totals_tell_null_keys_from_totals(spark):
    df = spark.createDataFrame([("s", "d"), ("s", None), (None, None)], "source string, domain string")
    got = {(r.source, r.domain, r.level): r.n_rows for r in Q.count_rollup(df).collect()}
    assert got == {("s", "d", 0): 1, ("s", None, 0): 1, (None, None, 0): 1, ("s", None, 1): 2, (None, None, 1): 1, (None, None, 3): 3}
    risk = spark.createDataFrame([("a", "low", "ok", 5, 0), ("a", "high", "no", 7, 2)], "c_mktsegment string, risk_tier string, recommendation string, revenue long, debt long")
    cube = {(r.c_mktsegment, r.risk_tier, r.recommendation, r.level): (r.n_customers, r.revenue_cents, r.n_zero_debt) for r in CJ.risk_cube(risk).collect()}
    assert cube[None, None, None, 7] == (2, 12, 1) and cube["a", None, None, 3] == (2, 12, 1) and cube[None, "low", None, 5] == (1, 5, 1) and len(cube) == 14


# --- the stream's outputs -------------------------------------------------------------------------------------------------------

def test_fanout_equals_batch_resumes_and_repeats_safely(spark, tmp_path):
    import uuid

    schema = "k bigint, text string"
    texts = ["Утас 99112233", "guaranteed approval, no fees", None, "", "Би 5 сая төгрөгийн зээл авмаар байна. Хугацаа 12 сар."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 4)], schema)
    source = str(tmp_path / "in")
    df.filter("k < 12").repartition(3).write.parquet(source)
    name = f"test_{uuid.uuid4().hex[:8]}"
    made = FO.outputs("k", "text")
    rows = lambda d: sorted((json.dumps(r.asDict(True), sort_keys=True, default=str) for r in d.collect()))

    def check(folder, whole):
        for n, make in made.items():
            want = make(whole)
            assert rows(FO.read_output(spark, folder, n, want)) == rows(want), n

    folder = FO.run_fanout(spark, source, schema, "k", "text", name, max_files_per_trigger=1)
    check(folder, df.filter("k < 12"))
    copy = str(tmp_path / "copy")
    spark.read.schema(schema).parquet(f"{folder}/input/batch=1").write.parquet(copy)
    FO.write_batch(spark.read.schema(schema).parquet(copy), 1, folder, made)  # the same batch once more
    check(folder, df.filter("k < 12"))
    df.filter("k >= 12").write.mode("append").parquet(source)
    assert FO.run_fanout(spark, source, schema, "k", "text", name) == folder
    check(folder, df)
    assert FO.read_output(spark, folder, "issues", made["issues"](df)).count() > 0
