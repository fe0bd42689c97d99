"""Rules and gates on records: every outcome occurs, and mixed failures keep the rules' order."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tallyspark.functions import credit as C
from tallyspark.operators import conversation as CV
from tallyspark.operators import gates as GT
from tallyspark.operators import quality as Q

SF = "/root/testdata/sf0.001"


def rows(spark, name):
    return E.queries()[name](spark, SF).collect()


V2_CODES = ["missing or invalid domain: bogus", "missing or invalid domain: None", "contains_pii must be false", "unexpected source metadata",
            "messages must use system/user/assistant format", "forbidden text found: <think>", "assistant output is mostly English",
            "assistant output is shorter than 80 Mongolian characters", "risk level or risk discussion is missing",
            "credit memo missing required field: Санал", "credit memo missing required field: Дутуу баримт",
            "credit memo missing required field: Шийдвэрийн үндэслэл", "numeric example has no calculated metric"]
V3_CODES = ["unknown domain 'bogus'", "unknown domain None", "unexpected source", "contains_pii must be false", "thinking tag found",
            "banned phrase found: ", "output is mostly English", "credit memo output shorter than 250 Mongolian characters",
            "missing required numeric field: ", "missing numeric field in prompt: expense", "missing numeric field in prompt: revenue",
            "metric mismatch for ", "numeric output has fewer than 3 calculated metric matches"]


@pytest.mark.parametrize("name,codes", [("quality_v2_damaged", V2_CODES), ("quality_v3_damaged", V3_CODES)])
def test_every_gate_rule_fires_and_clean_records_pass(spark, name, codes):
    got = rows(spark, name)
    found = {v for r in got for v in r.violations.split("|")}
    assert all(any(v.startswith(c) for v in found) for c in codes), [c for c in codes if not any(v.startswith(c) for v in found)]
    assert 0.3 < sum(not r.violations for r in got) / len(got) < 0.9


def test_verdicts_of_both_kinds(spark):
    got = {r.share: r.status for r in rows(spark, "quality_v3_sets")}
    assert got == {"clean": "PASS", "damaged": "FAIL"}
    v2 = rows(spark, "quality_v2_files")[0]
    assert v2.status == "FAIL" and v2.rows == 1500 and "bogus/" in v2.counts and v2.first_failure


def test_invariants_each_break(spark):
    got = rows(spark, "dataset_invariants_damaged")
    for c in ("n_metadata", "n_roles", "n_pii", "n_impolite", "n_no_final", "n_unsafe", "n_blank"):
        assert 0 < sum(r[c] for r in got) < sum(r.n_rows for r in got), c


def test_caller_dictionaries_on_documents(spark):
    got = rows(spark, "lexicon_documents")
    assert {r.decision for r in got} == {"pass", "review", "block"} and len({r.categories for r in got}) > 3
    assert any(r.n_issues > 1 and r.safer_md5 for r in got)
    assert len({r.glossary_warnings for r in rows(spark, "glossary_documents")}) > 1
    review = rows(spark, "review_documents")
    assert {r.requires_human_review for r in review} == {True, False} and len({r.confidence for r in review}) > 3
    assert {r.review_status for r in rows(spark, "governance_documents")} == {"needs_review", "auto_approved"}
    assert len({r.compliance_warnings for r in rows(spark, "rewrite_conversations")}) > 1


def test_loan_requests_fill_and_miss_every_field(spark):
    got = rows(spark, "loan_extraction_orders")
    for c in ("loan_amount", "loan_term_months", "monthly_income", "employment_status", "collateral", "loan_type", "phone_number"):
        values = {r[c] for r in got}
        assert len(values) > 2, c
        if c != "loan_amount":
            assert None in values, c
    assert len({r.confidence for r in rows(spark, "extraction_audit_orders")}) > 1


def test_all_tiers_occur(spark):
    got = rows(spark, "credit_tiers_orders")
    for c in ("risk_tier", "collateral_tier", "repayment_tier", "cashflow_tier"):
        assert {r[c] for r in got} == {C.LOW, C.MEDIUM, C.HIGH}, c
    assert {r.risk_tier for r in rows(spark, "customer_credit_facts")} == {C.LOW, C.MEDIUM, C.HIGH}


def test_scores_of_all_kinds(spark):
    assert {r.offline_score for r in rows(spark, "eval_scores_expected")} == {0.5, 0.65, 0.8}
    assert {r.service_score for r in rows(spark, "eval_scores_expected")} == {0.5, 0.8}
    got = rows(spark, "score_regression_expected")
    assert {r.regressed for r in got} == {True, False} and None in {r.candidate_score for r in got}


def test_gates_keep_and_drop(spark):
    assert {r.kept for r in rows(spark, "rights_flags")} == {True, False}
    prov = rows(spark, "provenance_missing")
    assert 0 < sum(r.n_complete for r in prov) < sum(r.n_docs for r in prov)
    assert {r.pair_ok for r in rows(spark, "preference_pairs")} == {True, False}
    assert {r.violations == "" for r in rows(spark, "field_domains")} == {True, False}
    assert 0 < len(rows(spark, "mongolian_filter")) < 1700


def test_messages_are_validated_one_by_one(spark):
    turns = [(1, 0, "user", " "), (1, 1, "robot", "x"), (1, 2, "assistant", "y"), (2, 0, "user", "a"), (2, 1, "robot", ""),
             (2, 2, "assistant", "y"), (3, 0, "user", "a"), (4, 0, "user", "a"), (4, 1, "system", "b"), (5, 0, "user", "a"),
             (5, 1, None, "b"), (5, 2, "assistant", None), (6, 0, "user", "a"), (6, 1, "assistant", "b")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    want = {1: CV.ERR_CONTENT, 2: "invalid role robot", 3: CV.ERR_FEW, 4: CV.ERR_ROLES, 5: "invalid role None", 6: None}
    assert {r.conv_id: r.error for r in CV.message_validation(df).collect()} == want
    assert {r.conv_id: r.e for r in CV.to_messages(df).select("conv_id", CV.validate_messages().alias("e")).collect()} == want


def test_context_of_all_user_turns(spark):
    turns = [(1, 0, "user", "I need a loan: 5 сая төгрөг зээл"), (1, 1, "assistant", "fine"), (1, 2, "user", "for 12 months"),
             (2, 0, "assistant", "hello"), (2, 1, "user", "thanks")]
    got = {r.conv_id: r.missing_application_fields for r in CV.chat_audit(spark.createDataFrame(
        turns, "conv_id long, turn long, role string, text string")).collect()}
    assert "loan_amount" not in got[1] and "loan_term_months" not in got[1] and "loan_amount" in got[2]


def test_flags_of_other_types(spark):
    df = spark.createDataFrame([("yes", 1.0, True), ("", 0.0, None), (None, None, False)], "s string, n double, b boolean")
    for c in df.columns:
        kept = df.withColumnRenamed(c, "contains_raw_customer_pii")
        assert GT.pii_exclusion(kept).count() == 2
    gold = df.withColumnRenamed("s", "google_translate_gold")
    assert GT.pii_exclusion(gold).count() == 3


def test_role_rule_and_unknown_domain_text(spark):
    df = spark.createDataFrame([("bogus",), (None,)], "domain string").select(
        "domain", F.lit("x").alias("source"), F.lit(False).alias("contains_pii"), F.lit("u").alias("user"), F.lit("a").alias("assistant"))
    got = [r.first_violation for r in Q.v3_violations(df).collect()]
    assert got == ["unknown domain 'bogus'", "unknown domain None"]
