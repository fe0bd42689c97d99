"""Gate and evaluation paths that the driver tables never trigger (every row valid there)."""

from pyspark.sql import functions as F

from tallyspark.functions import lending as L
from tallyspark.operators import evaluate as EV
from tallyspark.operators import gates as GT
from tallyspark.sources import dims


def test_pii_exclusion_and_declared_gate(spark):
    df = spark.createDataFrame(
        [(1, True, None, True), (2, None, True, False), (3, False, False, None), (4, None, None, True)],
        "id long, contains_raw_customer_pii boolean, google_translate_gold boolean, contains_pii boolean")
    assert sorted(r.id for r in GT.pii_exclusion(df).collect()) == [3, 4]
    kept, rejected = GT.declared_pii_gate(df)
    assert sorted(r.id for r in kept.collect()) == [2, 3]          # only boolean true rejects; null passes
    assert df.agg(rejected.alias("n")).first().n == 2
    kept_all, _ = GT.declared_pii_gate(df, allow_pii=True)
    assert kept_all.count() == 4


def test_size_guard(spark):
    df = spark.createDataFrame([(0,), (5,), (25,)], "n long")
    got = [r.g for r in df.select(GT.size_guard(F.col("n")).alias("g")).collect()]
    assert got == ["error: no records accepted", "error: dataset too small", "ok"]
    small_ok = [r.g for r in df.select(GT.size_guard(F.col("n"), allow_small=True).alias("g")).collect()]
    assert small_ok == ["error: no records accepted", "ok", "ok"]


def test_field_domain_violations(spark):
    df = spark.createDataFrame([("user", "hi", 0.5), ("bot", "", 1.5), (None, "x", None)],
                               "role string, text string, score double")
    v = df.select(GT.field_domain_violations({
        "role_enum": F.col("role").isin("system", "user", "assistant"),
        "content_min_length": F.length("text") >= 1,
        "score_range": F.col("score").between(0, 1),
    }).alias("v")).collect()
    assert [r.v for r in v] == [[], ["role_enum", "content_min_length", "score_range"], ["role_enum", "score_range"]]


def test_provenance_and_rights(spark):
    df = spark.createDataFrame([("u", "CC", "2025-01-01", "train"), (None, " ", None, ""), ("", None, "d", "x")],
                               "source_url string, license_status string, retrieval_date string, allowed_usage string")
    rows = df.select(GT.provenance_missing().alias("m"), GT.rights_ok().alias("ok")).collect()
    assert [r.m for r in rows] == [[], ["source_url", "retrieval_date", "allowed_usage"], ["source_url", "license_status"]]
    assert [r.ok for r in rows] == [True, False, False]


def test_score_regression_full_outer(spark):
    cand = spark.createDataFrame([("a", 0.8), ("b", 0.5), ("c", 0.65)], "item_id string, score double")
    prod = spark.createDataFrame([("a", 0.8), ("b", 0.8), ("d", 0.5)], "item_id string, score double")
    r = {x.item_id: x for x in EV.regression(cand, prod).collect()}
    assert r["b"].regressed and not r["a"].regressed
    assert r["c"].production_score is None and r["d"].candidate_score is None and not r["d"].regressed


def test_category_coverage_and_average(spark):
    items = spark.createDataFrame([("borrower_chat",), ("borrower_chat",), ("compliance_rewrite",)], "task string")
    cov = {r.task: r.n_items for r in EV.category_coverage(items).collect()}
    assert cov["borrower_chat"] == 2 and cov["loan_extraction"] == 0 and len(cov) == 6
    empty = spark.createDataFrame([], "score double")
    assert empty.agg(EV.average().alias("a")).first().a == 0.0


def test_template_metadata_and_review_routing(spark):
    items = dims.attach_template_metadata(spark.createDataFrame([("x",)], "id string")).first()
    assert items.metadata == {"license": "template", "compliance_review_required": "true"}
    df = spark.createDataFrame([(0.73, 0, False), (0.80, 1, False), (0.90, 0, True), (0.90, 0, False)],
                               "c double, n int, req boolean")
    needs, reason = L.review_routing(F.col("c"), F.col("n"), F.col("req"))
    got = [(r.x, r.y is not None) for r in df.select(needs.alias("x"), reason.alias("y")).collect()]
    assert got == [(True, True), (True, True), (True, True), (False, False)]


def test_compute_once_attaches_to_every_copy(spark):
    from tallyspark.operators import split as SP
    df = spark.createDataFrame([(1, "same"), (2, "same"), (3, "other"), (4, "same")], "id long, payload string")
    out = SP.compute_once(df, SP.content_key("p", F.col("payload")), "payload", F.upper, "upper").collect()
    got = {r.id: (r.cache_key, r.upper) for r in out}
    assert len(got) == 4 and got[1] == got[2] == got[4] and got[1][1] == "SAME" and got[3][1] == "OTHER"
    assert got[1][0].startswith("p:") and len(got[1][0]) == 2 + 64


def test_messages_round_trip(spark):
    from tallyspark.operators import conversation as CV
    turns = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "user", "c")],
                                  "conv_id long, turn long, role string, text string")
    back = {(r.conv_id, r.pos): (r.role, r.text) for r in CV.to_turns(CV.to_messages(turns)).collect()}
    assert back == {(1, 0): ("user", "a"), (1, 1): ("assistant", "b"), (2, 0): ("user", "c")}
