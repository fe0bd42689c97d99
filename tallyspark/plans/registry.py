"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables (or data Spark derives from them), so its
work grows with the tables. Result columns are flat scalars with stable names;
arrays are rendered with a separator so the results compare across engines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import corpus
from ..sources.tables import dealt, spread, table

QUERIES: dict = {}


def query(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# --- documents ---------------------------------------------------------------

@query("pii_flags_by_source")
def q_pii_flags_by_source(spark, sf_dir):
    return corpus.pii_flags_by_source(spread(table(spark, sf_dir, "documents").select("source", "lang", "text")))


@query("redact_documents")
def q_redact_documents(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return corpus.redact(docs).select("doc_id", "source", "redacted_text", "redaction_changed")


@query("redaction_report")
def q_redaction_report(spark, sf_dir):
    return corpus.redaction_report(spread(table(spark, sf_dir, "documents").select("source", "text")))


@query("clean_text_share")
def q_clean_text_share(spark, sf_dir):
    return corpus.clean_text_share(spread(table(spark, sf_dir, "documents").select("lang", "text")), keys=("lang",))


@query("script_profile")
def q_script_profile(spark, sf_dir):
    return corpus.script_profile(spread(table(spark, sf_dir, "documents").select("lang", "text")))


# --- generators (indexed by orders.o_orderkey, so they grow with the table) ------

from ..operators import generate as G  # noqa: E402


def v1_corpus(spark, sf_dir):
    return G.sft_v1(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("idx")))


def v2_corpus(spark, sf_dir):
    return G.sft_v2(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("idx")))


def v3_corpus(spark, sf_dir):
    return G.sft_v3(table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("gidx")))


def generated(spark, sf_dir, version, fn=None, lay_out=None):
    """Generated records (texts by the content dimension), with ``fn``, a rule or gate, applied to every record.
    ``lay_out``: what deals the keys to tasks, instead of even parts."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")  # keys only: the texts are made after
    if lay_out is None:
        orders = dealt(orders)
    if version == "v1":
        keys, content = G.v1_keys(orders.select(F.col("o_orderkey").alias("idx"))), G.content_v1(spark)
        meta = [F.lit(T1V.SOURCE).alias("source"), F.lit(T1V.LICENSE_STATUS).alias("license_status"),
                F.lit(T1V.ALLOWED_USAGE).alias("allowed_usage"), F.lit(False).alias("contains_pii")]
    elif version == "v2":
        keys, content = G.v2_keys(orders.select(F.col("o_orderkey").alias("idx"))), G.content_v2(spark)
        meta = [F.lit(T2.SOURCE).alias("source"), F.lit(False).alias("contains_pii"),
                F.lit(True).alias("numeric_example")]
    else:
        keys, content = G.v3_keys(orders.select((F.col("o_orderkey") + 1).alias("gidx"))), G.content_v3(spark)
        meta = [F.lit(T3.SOURCE).alias("source"), F.lit(False).alias("contains_pii"),
                (F.col("domain") != "missing_documents_request").alias("numeric_example")]
    if lay_out is not None:
        keys = lay_out(keys)
    records = G.attach(keys, content.select("*", *meta))
    return fn(records) if fn is not None else records


@query("sft_v1_generate")
def q_sft_v1(spark, sf_dir):
    return v1_corpus(spark, sf_dir)


@query("sft_v2_generate")
def q_sft_v2(spark, sf_dir):
    return v2_corpus(spark, sf_dir)


@query("sft_v3_generate")
def q_sft_v3(spark, sf_dir):
    return v3_corpus(spark, sf_dir)


# --- lending-language rules over the generated v1 corpus and the documents --------

from ..functions import lending as L  # noqa: E402
from ..functions import text as TX  # noqa: E402
from ..operators import conversation as CV  # noqa: E402
from ..operators import credit_jobs as CJ  # noqa: E402
from ..operators import evaluate as EV  # noqa: E402
from ..operators import lending_jobs as LJ  # noqa: E402
from ..operators import quality as Q  # noqa: E402
from ..operators import split as SP  # noqa: E402
from ..operators import templates_v2 as T2  # noqa: E402
from ..operators import templates_v1 as T1V  # noqa: E402
from ..operators import templates_v3 as T3  # noqa: E402
from ..functions import vocab as VO  # noqa: E402


def _join(col, sep="|"):
    return F.array_join(col, sep)


@query("compliance_issues")
def q_compliance_issues(spark, sf_dir):
    s = generated(spark, sf_dir, "v1", lambda d: LJ.compliance_scan(d, "user"))
    return s.select("idx", F.size("issues").alias("n_issues"),
                    _join(F.col("compliance_warnings")).alias("categories"),
                    _join(F.transform("issues", lambda i: i["phrase"])).alias("phrases"),
                    "is_safe", "decision")


@query("compliance_safer_text")
def q_compliance_safer(spark, sf_dir):
    s = generated(spark, sf_dir, "v1", lambda d: LJ.compliance_scan(d, "user"))
    return s.select("idx", "safer_text", _join(F.col("safer_alternatives")).alias("alternatives"))


@query("compliance_report")
def q_compliance_report(spark, sf_dir):
    # the user and the assistant text of every record
    both = generated(spark, sf_dir, "v1").select("domain", F.explode(F.array("user", "assistant")).alias("text"))
    return LJ.compliance_report(LJ.compliance_scan(both, "text"), keys=("domain",))


@query("glossary_check")
def q_glossary_check(spark, sf_dir):
    g = generated(spark, sf_dir, "v1", lambda d: LJ.glossary_job(d, "user", VO.FINANCE_GLOSSARY_ID))
    return g.select("idx", _join(F.col("terms_used")).alias("terms_used"),
                    _join(F.col("glossary_warnings")).alias("glossary_warnings"),
                    F.size("glossary_warnings").alias("n_warnings"))


def _extraction_cols(df, key):
    return df.select(key, "loan_amount", "loan_term_months", "monthly_income", "employment_status",
                     "collateral", "loan_type", "phone_number",
                     _join(F.col("missing_fields"), ",").alias("missing_fields"),
                     F.size("missing_fields").alias("n_missing"))


@query("loan_extraction")
def q_loan_extraction(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return _extraction_cols(LJ.extraction_job(docs, "text"), "doc_id")


@query("loan_extraction_sft")
def q_loan_extraction_sft(spark, sf_dir):
    return _extraction_cols(generated(spark, sf_dir, "v1", lambda d: LJ.extraction_job(d, "user")), "idx")


@query("missing_fields_report")
def q_missing_fields_report(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("source", "text"))
    return LJ.completeness_report(LJ.extraction_job(docs, "text"), keys=("source",))


@query("confidence_scores")
def q_confidence_scores(spark, sf_dir):
    e = generated(spark, sf_dir, "v1", lambda d: LJ.extraction_job(d, "user"))
    return e.select("idx", "domain", "confidence")


@query("review_routing")
def q_review_routing(spark, sf_dir):
    # every generated record: its user text is the source, its assistant text the output
    r = generated(spark, sf_dir, "v1", lambda d: LJ.review_job(d, "assistant", "user", glossary_id=VO.FINANCE_GLOSSARY_ID,
                                                                compliance_sensitive=True))
    return r.select("idx", "confidence", "requires_human_review", "reason",
                    F.size("glossary_warnings").alias("n_glossary_warnings"),
                    _join(F.col("terms_used")).alias("terms_used"))


@query("strip_reasoning")
def q_strip_reasoning(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("role", "text")
    return corpus.reasoning_report(turns, keys=("role",))


# --- conversations ---------------------------------------------------------------------

@query("conversation_messages")
def q_conversation_messages(spark, sf_dir):
    return CV.conversation_summary(table(spark, sf_dir, "conversations"))


@query("latest_user_turn")
def q_latest_user_turn(spark, sf_dir):
    return CV.latest_user_turn(table(spark, sf_dir, "conversations"))


@query("message_validation")
def q_message_validation(spark, sf_dir):
    return CV.message_validation(table(spark, sf_dir, "conversations")).select("conv_id", "error")


@query("chat_audit")
def q_chat_audit(spark, sf_dir):
    a = CV.chat_audit(table(spark, sf_dir, "conversations"))
    return a.select("conv_id", "language", "confidence", F.size("issues").alias("n_issues"),
                    F.array_join("missing_application_fields", ",").alias("missing_application_fields"))


@query("context_missing_fields")
def q_context_missing(spark, sf_dir):
    a = CV.chat_audit(table(spark, sf_dir, "conversations"))  # unused columns, texts among them, are pruned
    return a.select("conv_id", F.array_join("missing_application_fields", ",").alias("missing_application_fields"))


# --- credit ---------------------------------------------------------------------------------

def v2_metrics(spark, sf_dir):
    return G.metrics_v2(G.scenario_v2(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("idx"))))


def v3_metrics(spark, sf_dir):
    return G.metrics_v3(G.scenario_v3(table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("gidx"))))


@query("credit_ratios_v2")
def q_credit_ratios_v2(spark, sf_dir):
    return v2_metrics(spark, sf_dir).select("idx", "profit", "profit_margin", "expense_ratio", "debt_to_revenue",
                                            "cash_to_debt", "monthly_repayment", "collateral_coverage")


@query("credit_ratios_v3")
def q_credit_ratios_v3(spark, sf_dir):
    return v3_metrics(spark, sf_dir).select("gidx", "profit", "profit_margin", "expense_ratio", "debt_to_revenue",
                                            "cash_to_debt", "monthly_repayment")


@query("risk_tiers")
def q_risk_tiers(spark, sf_dir):
    v2 = v2_metrics(spark, sf_dir).select(F.lit("v2").alias("version"), F.col("risk_tier"),
                                          F.lit(None).cast("string").alias("recommendation"))
    v3 = v3_metrics(spark, sf_dir).select(F.lit("v3").alias("version"), "risk_tier", "recommendation")
    return v2.unionByName(v3).groupBy("version", "risk_tier", "recommendation").agg(F.count(F.lit(1)).alias("n"))


@query("red_flags")
def q_red_flags(spark, sf_dir):
    m = v2_metrics(spark, sf_dir)
    return m.select("idx", F.array_join("red_flags", ", ").alias("flags"), F.size("red_flags").alias("n_flags"))


@query("red_flag_frequency")
def q_red_flag_frequency(spark, sf_dir):
    return CJ.red_flag_frequency(v2_metrics(spark, sf_dir))


@query("collateral_tiers")
def q_collateral_tiers(spark, sf_dir):
    return v2_metrics(spark, sf_dir).select("idx", "collateral_coverage", "collateral_tier")


@query("repayment_tiers")
def q_repayment_tiers(spark, sf_dir):
    return v2_metrics(spark, sf_dir).select("idx", "repayment_coverage", "repayment_tier")


@query("cashflow_tiers")
def q_cashflow_tiers(spark, sf_dir):
    return v2_metrics(spark, sf_dir).select("idx", "net_after_debt", "cashflow_tier")


def customer_risk_table(spark, sf_dir):
    facts = CJ.customer_facts(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"),
                              table(spark, sf_dir, "lineitem"))
    return CJ.customer_risk(facts)


@query("customer_risk_rollup")
def q_customer_risk_rollup(spark, sf_dir):
    return CJ.risk_rollup(customer_risk_table(spark, sf_dir), keys=("c_mktsegment",))


@query("customer_credit_facts")
def q_customer_credit_facts(spark, sf_dir):
    return customer_risk_table(spark, sf_dir).select(
        "c_custkey", "revenue", "expense", "debt", "cash", "profit", "profit_margin", "debt_to_revenue",
        "cash_to_debt", "risk_tier", "recommendation")


# --- splits and memoisation -----------------------------------------------------------------

@query("seeded_split")
def q_seeded_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return SP.seeded_split(docs, "doc_id", seed=42, val_ratio=0.1).select("doc_id", "split")


@query("prefix_split")
def q_prefix_split(spark, sf_dir):
    keys = G.v2_keys(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("idx")))
    return SP.prefix_split(keys.select("idx"), "idx", 0.9).select("idx", "split")


@query("sft_v3_stratified_split")
def q_v3_split(spark, sf_dir):
    v3 = G.v3_keys(table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("gidx"))).select("gidx", "domain")
    return SP.stratified_prefix_split(v3, "domain", "gidx", 0.9).select("gidx", "domain", "group_rank", "split")


@query("dedup_by_hash")
def q_dedup_by_hash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    once = SP.compute_once(docs, SP.content_key("doc", F.col("text")), "text",
                           lambda t: L.heuristic_confidence(TX.redact_pii(t), F.lit(0)), "confidence")
    return once.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"),
                                      F.count_distinct("cache_key").alias("n_distinct_payloads"),
                                      (F.count(F.lit(1)) - F.count_distinct("cache_key")).alias("n_cache_hits"),
                                      F.sum(F.round(F.col("confidence") * 100).cast("bigint")).alias("confidence_points"))


# --- quality gates -----------------------------------------------------------------------

@query("quality_v2")
def q_quality_v2(spark, sf_dir):
    checked = generated(spark, sf_dir, "v2", Q.v2_violations)
    return checked.select("idx", "domain", "mn_chars", "metric_terms", "first_violation",
                          F.size("violations").alias("n_violations"))


@query("quality_v3")
def q_quality_v3(spark, sf_dir):
    checked = generated(spark, sf_dir, "v3", Q.v3_violations)
    return checked.select("gidx", "domain", "mn_chars", "metric_matches", "first_violation",
                          F.size("violations").alias("n_violations"))


@query("quality_v3_verdict")
def q_quality_v3_verdict(spark, sf_dir):
    return Q.verdict(generated(spark, sf_dir, "v3", Q.v3_violations), "gidx")


@query("prompt_figures_roundtrip")
def q_figures_roundtrip(spark, sf_dir):
    def roundtrip(d):
        scen = G.scenario_v3(d.select("gidx"), "gidx")
        return Q.figures_roundtrip(d.join(scen, "gidx"), keys=("gidx", "domain"))
    r = generated(spark, sf_dir, "v3", roundtrip)
    return r.select("gidx", *[f"parsed_{k}" for k, _l, _u in T3.PROMPT_FIGURES], "roundtrip_ok")


@query("domain_coverage")
def q_domain_coverage(spark, sf_dir):
    return Q.domain_coverage(generated(spark, sf_dir, "v2").select("domain"), T2.TASKS)


@query("domain_quota")
def q_domain_quota(spark, sf_dir):
    v3 = G.v3_keys(table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("gidx")))  # the domain needs no text
    n = v3.count()
    exp = Q.cycle_expected_counts(n)
    expected = spark.createDataFrame(list(exp.items()), "domain string, expected bigint")
    actual = v3.groupBy("domain").agg(F.count(F.lit(1)).alias("actual"))
    return (expected.join(actual, "domain", "full_outer")
                    .withColumn("matches", F.col("expected").eqNullSafe(F.col("actual"))))


@query("dataset_invariants")
def q_dataset_invariants(spark, sf_dir):
    """Q7 over the generated v1 set. Content rules run once per distinct content; the
    PII scan of a whole record = scan of its content OR scan of its id (no match can
    span the id and the next field)."""
    unsafe = ["заавал батална", "баталгаатай зөвшөөрнө", "guaranteed approval", "final approval is confirmed"]

    def flags(d):
        text = F.concat_ws("\n", "system", "user", "assistant", "domain", "source")
        low = F.lower("assistant")
        return d.select("idx", "domain", "source", "license_status", "allowed_usage", "contains_pii",
                        (TX.has_phone(text) | TX.has_email(text) | TX.has_register(text)).alias("_pii"),
                        (~F.col("assistant").contains("Та")).alias("_impolite"),
                        (~low.contains("эцсийн")).alias("_no_final"),
                        F.greatest(*[low.contains(p) for p in unsafe]).alias("_unsafe"),
                        (TX.is_blank("system") | TX.is_blank("user") | TX.is_blank("assistant")).alias("_blank"))
    v1 = generated(spark, sf_dir, "v1", flags).withColumn("id", F.format_string(T1V.ID_FORMAT, F.col("idx") + 1))
    id_pii = TX.has_phone(F.col("id")) | TX.has_email(F.col("id")) | TX.has_register(F.col("id"))
    by_domain = v1.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_and((F.col("source") == T1V.SOURCE) & (F.col("license_status") == T1V.LICENSE_STATUS)
                   & (F.col("allowed_usage") == T1V.ALLOWED_USAGE) & F.col("contains_pii").eqNullSafe(False)).alias("ok"),
        F.count_if(F.col("_pii") | id_pii).alias("pii"), F.count_if("_impolite").alias("impolite"),
        F.count_if("_no_final").alias("no_final"), F.count_if("_unsafe").alias("unsafe"), F.count_if("_blank").alias("blank"))
    return by_domain.agg(  # one row a domain
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.bool_and("ok").alias("metadata_ok"), F.sum("pii").alias("n_pii_rows"),
        F.sum("impolite").alias("n_impolite"), F.sum("no_final").alias("n_no_final_review"), F.sum("unsafe").alias("n_unsafe"),
        F.sum("blank").alias("n_blank_messages"), F.min("n").alias("min_domain_rows"), F.max("n").alias("max_domain_rows"),
        F.count(F.lit(1)).alias("n_domains"))


# --- evaluation ------------------------------------------------------------------------------

@query("eval_scores")
def q_eval_scores(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id"), EV.offline_score("text").alias("offline_score"),
                    EV.service_score("text").alias("service_score"))


@query("eval_summary")
def q_eval_summary(spark, sf_dir):
    scores = EV.score_items(table(spark, sf_dir, "benchmark"), "item_id", "text", "offline")
    return EV.summary(scores).drop("mean_score_raw")


@query("score_regression")
def q_score_regression(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark")
    cand = EV.score_items(b, "item_id", "text", "offline")
    prod = EV.score_items(b, "item_id", "text", "service")
    r = EV.regression(cand, prod)
    return r.agg(F.count(F.lit(1)).alias("n_items"), F.count_if("regressed").alias("n_regressed"),
                 F.round(F.avg("delta"), 6).alias("mean_delta"))


@query("labelled_quality_report")
def q_labelled_quality(spark, sf_dir):
    labelled = table(spark, sf_dir, "documents").select("doc_id", "text").join(table(spark, sf_dir, "labels"), "doc_id")
    j = corpus.pii_flags(labelled)  # only labelled documents are scanned
    return j.groupBy("quality", "toxic").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(F.col("has_phone") | F.col("has_email") | F.col("has_register") | F.col("has_long_number"))
         .alias("n_pii_docs"))


# --- gates, sources, reshapes, streaming -----------------------------------------------------

import uuid  # noqa: E402

from ..operators import gates as GT  # noqa: E402
from ..sources import dims as DM  # noqa: E402
from ..streaming import redaction as SR  # noqa: E402

RETRIEVAL_DATE = "2025-01-01"


def _doc_provenance(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return GT.document_provenance(docs, DM.source_manifest(spark, RETRIEVAL_DATE))


@query("rights_gate")
def q_rights_gate(spark, sf_dir):
    p = _doc_provenance(spark, sf_dir)
    return p.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"),
                                   F.count_if(GT.rights_ok()).alias("n_kept"))


@query("provenance_missing")
def q_provenance_missing(spark, sf_dir):
    p = _doc_provenance(spark, sf_dir).withColumn("missing", GT.provenance_missing())
    aggs = [F.count(F.lit(1)).alias("n_docs")]
    for f in GT.PROVENANCE_FIELDS:
        aggs.append(F.count_if(F.array_contains("missing", f)).alias(f"n_missing_{f}"))
    aggs.append(F.count_if(F.size("missing") == 0).alias("n_complete"))
    return p.groupBy("source").agg(*aggs)


@query("usage_eligibility")
def q_usage_eligibility(spark, sf_dir):
    p = _doc_provenance(spark, sf_dir)
    return p.groupBy("source", "manifest_name", "allowed_usage").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if(GT.usage_eligible()).alias("n_eligible"))


@query("source_manifest")
def q_source_manifest(spark, sf_dir):
    p = _doc_provenance(spark, sf_dir)
    return p.groupBy("manifest_name", "source_url").agg(
        F.count_distinct("source").alias("n_sources"), F.count(F.lit(1)).alias("n_docs"))


def _pairs(spark, sf_dir):
    t = table(spark, sf_dir, "conversations")
    u = t.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("source_text"))
    a = t.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                                      F.col("text").alias("target_text"))
    pairs = u.join(a, ["conv_id", "turn"], "inner")
    m = DM.source_manifest(spark, RETRIEVAL_DATE).select(F.col("ord").alias("_mord"), "source_url",
                                                          "license_status", "allowed_usage", "retrieval_date")
    return (pairs.withColumn("_mord", F.pmod("conv_id", F.lit(len(DM.MANIFEST))).cast("int"))
                 .join(F.broadcast(m), "_mord", "left").drop("_mord"))


@query("translation_pairs")
def q_translation_pairs(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    shaped = G.translation_pairs(pairs.withColumn("k", F.struct("conv_id", "turn")))
    return shaped.select(F.col("messages")[1]["content"].alias("source_text"),
                         F.col("messages")[2]["content"].alias("target_text"),
                         F.col("metadata.license_status").alias("license_status"),
                         F.col("metadata.allowed_usage").alias("allowed_usage"),
                         F.col("metadata.source_url").alias("source_url"))


@query("teacher_records")
def q_teacher_records(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    seeds = t.groupBy("conv_id").agg(F.min_by("text", "turn").alias("prompt")).select(
        F.col("conv_id").alias("id"), "prompt", F.lit(None).cast("string").alias("domain"),
        F.lit(None).cast("string").alias("language"), F.lit(None).cast("boolean").alias("contains_pii"))
    rec = G.teacher_records(seeds)
    return rec.select("id", F.col("messages")[2]["content"].alias("assistant"), "domain", "language",
                      "contains_pii", "human_review_required")


@query("log_redaction_stream")
def q_log_redaction_stream(spark, sf_dir):
    # a fresh name: the query's result is the whole table's, not what came since an earlier call
    sink = SR.run_file_stream(spark, f"{sf_dir.rstrip('/')}/documents.parquet", "doc_id bigint, source string, text string",
                              "text", f"log_redaction_{uuid.uuid4().hex[:12]}")
    return spark.read.schema("doc_id bigint, source string, redacted_text string").parquet(sink)


# --- preparation, validation and audit jobs ------------------------------------------------

from ..functions import vocab as VO  # noqa: E402
from ..sources import jsonl as JS  # noqa: E402


@query("pii_exclusion")
def q_pii_exclusion(spark, sf_dir):
    """F3 on documents whose raw-customer-PII flag is the detected PII."""
    d = corpus.pii_flags(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    d = d.withColumn("contains_raw_customer_pii", F.col("has_phone") | F.col("has_email") | F.col("has_register"))
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if(GT.pii_kept(d)).alias("n_kept"))


def _conversation_records(spark, sf_dir):
    """Conversations as records: F5 error + declared PII flag (T2 over the turns), by aggregates."""
    turns = table(spark, sf_dir, "conversations")
    flagged = corpus.pii_flags(turns).withColumn("_pii", F.col("has_phone") | F.col("has_email") | F.col("has_register"))
    pii = flagged.groupBy("conv_id").agg(F.bool_or("_pii").alias("contains_pii"))
    return CV.message_validation(turns).join(pii, "conv_id")


@query("sft_prep_summary")
def q_sft_prep_summary(spark, sf_dir):
    """E1 as one job: F5 quarantine -> F4 PII gate -> F8 guard -> X1 sizes -> A8 summary row."""
    valid = F.col("error").isNull()
    summary = _conversation_records(spark, sf_dir).agg(  # one aggregate over the records
        F.count_if(valid).alias("n_valid"), F.count_if(~valid).alias("quarantined"),
        F.count_if(valid & F.col("contains_pii").eqNullSafe(True)).alias("rejected_contains_pii"))
    summary = summary.withColumn("accepted", F.col("n_valid") - F.col("rejected_contains_pii"))
    n = F.col("accepted")
    val = F.when(n > 1, F.greatest(F.lit(1), F.floor(n * F.lit(0.1)).cast("bigint"))).otherwise(F.lit(0))
    return (summary
            .withColumn("validation", val)
            .withColumn("train", F.when(n - val > 0, n - val).otherwise(n))
            .withColumn("guard", GT.size_guard(n, allow_small=False))
            .drop("n_valid"))


@query("field_validation")
def q_field_validation(spark, sf_dir):
    """F11 on conversation turns: enum, length and range rules; violation counts by rule."""
    t = table(spark, sf_dir, "conversations")
    v = t.withColumn("violations", GT.field_domain_violations({
        "role_enum": F.col("role").isin("system", "user", "assistant"),
        "content_min_length": F.length("text") >= 1,
        "turn_non_negative": F.col("turn") >= 0,
    }))
    return (v.select(F.explode("violations").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
             .unionByName(t.agg(F.lit("rows_checked").alias("rule"), F.count(F.lit(1)).alias("n"))))


@query("message_accessors")
def q_message_accessors(spark, sf_dir):
    """Last message (assistant answer) and second message (user prompt); '' under 3 messages (v2 rule)."""
    return CV.message_accessors(table(spark, sf_dir, "conversations"))


CHAT_SYSTEM = ("You are a polite borrower support assistant for Lendex and Datagate. "  # FIXED VALUE
               "Default to Mongolian. If the user writes Mongolian, answer in Mongolian; English, answer in English; "
               "mixed, answer in the dominant language. Use polite 'Ta' for Mongolian borrowers. "
               "Never promise loan approval. Ask for missing loan application fields when needed. "
               "Missing fields: ")


@query("chat_prompts")
def q_chat_prompts(spark, sf_dir):
    """The chat system prompt per conversation (missing fields from the turns' context)."""
    a = CV.chat_audit(table(spark, sf_dir, "conversations"))
    missing = F.when(F.size("missing_application_fields") > 0,
                     F.array_join("missing_application_fields", ", ")).otherwise(F.lit("none"))
    return a.select("conv_id", F.concat(F.lit(CHAT_SYSTEM), missing, F.lit(".")).alias("system_prompt"))


@query("rewrite_audit")
def q_rewrite_audit(spark, sf_dir):
    """T22 over every generated record (user text -> assistant rewrite)."""
    # every generated record: its user text is the input, its assistant text the rewrite
    r = generated(spark, sf_dir, "v1", lambda d: LJ.rewrite_audit(d, "user", "assistant", VO.FINANCE_GLOSSARY_ID))
    return r.select("idx", F.array_join("compliance_warnings", "|").alias("compliance_warnings"),
                    F.size("safer_alternatives").alias("n_alternatives"), "confidence")


@query("benchmark_coverage")
def q_benchmark_coverage(spark, sf_dir):
    """Required benchmark categories against the task mix of the generated item set."""
    return EV.category_coverage(generated(spark, sf_dir, "v1").select(F.col("domain").alias("task")))


@query("governance_audit")
def q_governance_audit(spark, sf_dir):
    """One audit row per processed record (versions, compliance result, review status)."""
    def audit(d):
        s = LJ.compliance_scan(d, "assistant")
        conf = L.heuristic_confidence(F.col("assistant"), F.size("compliance_warnings"))
        needs, _ = L.review_routing(conf, F.size("issues"))
        return s.withColumn("confidence", conf).withColumn("_needs", needs)
    v1 = generated(spark, sf_dir, "v1", audit)
    conf, needs = F.col("confidence"), F.col("_needs")
    return v1.select("idx", F.lit(VO.MOCK_TEACHER_MODEL).alias("model"),
                     F.lit("sft_v1").alias("prompt_version"), F.lit(VO.FINANCE_GLOSSARY_ID).alias("glossary_version"),
                     F.col("is_safe").alias("compliance_ok"), conf.alias("confidence"),
                     F.when(needs, "needs_review").otherwise("auto_approved").alias("review_status"))


@query("benchmark_items")
def q_benchmark_items(spark, sf_dir):
    """Benchmark rows as items with the constant template metadata attached."""
    items = DM.attach_template_metadata(table(spark, sf_dir, "benchmark"))
    return items.select("item_id", F.length("text").alias("input_chars"),
                        F.array_join(F.array_sort(F.transform(F.map_entries("metadata"),
                                                              lambda e: F.concat(e["key"], F.lit("="), e["value"]))),
                                     ";").alias("metadata"))


@query("jsonl_roundtrip")
def q_jsonl_roundtrip(spark, sf_dir):
    """S4 -> S1: write the v2 set as JSONL (messages + nested metadata) and read it back with its schema."""
    from ..session import shared_path
    recs = G.nested_metadata(v2_corpus(spark, sf_dir).drop("idx"),
                             keys=("domain", "source", "license_status", "allowed_usage", "contains_pii",
                                   "numeric_example", "metrics_expected"))
    path = shared_path(spark, f"jsonl/sft_v2_{uuid.uuid4().hex[:12]}")
    JS.write_jsonl(recs, path, compression="gzip")
    back = JS.read_jsonl(spark, path, JS.SFT_NESTED)
    return back.select("id", F.size("messages").alias("n_messages"), F.col("metadata.domain").alias("domain"),
                       F.md5(F.element_at("messages", -1)["content"]).alias("assistant_md5"))


@query("quality_v2_verdict")
def q_quality_v2_verdict(spark, sf_dir):
    return Q.verdict(generated(spark, sf_dir, "v2", Q.v2_violations), "idx")


# --- S6: glossary recovered from the generated translation records, overlaid on the defaults ---

TRANSLATION_TERM_EN = "Please review the (.+?) for a "   # FIXED VALUE: v1 translation prompt wording
TRANSLATION_TERM_MN = "зээлийн (.+?)-ийг хянана"          # FIXED VALUE: v1 translation answer wording


@query("glossary_overlay")
def q_glossary_overlay(spark, sf_dir):
    """S6 on a glossary table derived from the data: (English term, Mongolian term) pairs read
    back from every generated record whose texts carry the translation wording (ord = first
    record index), overlaid on the default glossary."""
    def terms(d):
        return d.select("idx", "domain", F.regexp_extract("user", TRANSLATION_TERM_EN, 1).alias("term"),
                        F.regexp_extract("assistant", TRANSLATION_TERM_MN, 1).alias("preferred"))
    # records where both wordings occur (the translation records) give the pairs
    pairs = generated(spark, sf_dir, "v1", terms).filter((F.col("term") != "") & (F.col("preferred") != ""))
    file_df = (pairs.groupBy("term").agg(F.min("idx").alias("ord"), F.min_by("preferred", "idx").alias("preferred"))
                    .select(F.lit("corpus").alias("glossary_id"), "ord", "term", "preferred"))
    return LJ.glossary_overlay(file_df)


from . import records as _records  # noqa: E402,F401  (registers its queries)
from . import files as _files  # noqa: E402,F401
from . import jobs as _jobs  # noqa: E402,F401
from . import said as _said  # noqa: E402,F401
