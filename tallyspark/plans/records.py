"""Registered queries in which rules and gates meet records whose outcomes differ.

Inputs are records of the driver tables, or derived from them: documents and conversations with a caller's own lexicon and
glossary, one loan request per order, and generated records of which a key-dependent share is damaged, one
damage per rule. The expressions that make an input are plain SQL that Spark and the oracle's engine read alike; the rules
themselves are written separately on both sides.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lending as L
from ..functions import text as TX
from ..operators import conversation as CV
from ..operators import corpus
from ..operators import evaluate as EV
from ..operators import gates as GT
from ..operators import generate as G
from ..operators import lending_jobs as LJ
from ..operators import quality as Q
from ..operators import templates_v1 as T1
from ..operators import templates_v3 as T3
from ..session import shared_path
from ..sources import dims as DM
from ..sources import jsonl as JS
from ..sources.tables import dealt, spread, table
from .registry import _extraction_cols, _join, generated, query

# --- a caller's dictionaries --------------------------------------------------------------------------------------

#: (ord, category, phrase, severity, alternative)
CALLER_LEXICON = [
    (0, "insult", "stupid", "high", "unwise"), (1, "insult", "idiot", "high", "person"),
    (2, "insult", "moron", "medium", "person"), (3, "waste", "Trash", "low", "waste"),
    (4, "rights", "all rights reserved", "medium", "see the terms"), (5, "rights", "icense", "low", "ermit"),
    (6, "secret", "password=", "high", "secret="), (7, "secret", "AKIA", "high", "KEY"),
]
CALLER_GLOSSARY = [("license", "permit"), ("password", "passcode"), ("stupid", "unwise"), ("the", "that"), ("trash", "waste")]
LEXICON_SCHEMA = "ord int, category string, phrase string, severity string, alternative string"


def _docs(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _scan_out(scanned: DataFrame, key: str) -> DataFrame:
    return scanned.select(key, F.size("issues").alias("n_issues"), _join(F.col("compliance_warnings")).alias("categories"),
                          _join(F.transform("issues", lambda i: i["phrase"])).alias("phrases"),
                          _join(F.col("safer_alternatives")).alias("alternatives"), "is_safe", "decision",
                          F.md5("safer_text").alias("safer_md5"))


@query("lexicon_documents")
def lexicon_documents(spark, sf_dir):
    """A caller's lexicon table over every document."""
    return _scan_out(LJ.compliance_scan_table(_docs(spark, sf_dir), "text", spark.createDataFrame(CALLER_LEXICON, LEXICON_SCHEMA)), "doc_id")


def _word_lexicon(texts: DataFrame, letters: int) -> DataFrame:
    """The distinct words of at least so many letters as a lexicon of three severities."""
    words = (texts.select(F.explode(F.split(F.lower("text"), "[^a-zà-ÿ]+")).alias("phrase"))
             .filter(F.length("phrase") >= letters).distinct())
    return words.selectExpr("crc32(CAST(phrase AS BINARY)) AS ord", "'word' AS category", "phrase",
                            "CASE length(phrase) % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS severity",
                            "'…' AS alternative")


def _word_hits(spark, sf_dir, lexicon: DataFrame) -> DataFrame:
    scanned = LJ.compliance_scan_table(_docs(spark, sf_dir), "text", lexicon, unroll_max=0)  # the index at every size
    return scanned.select("doc_id", F.size("issues").alias("n_issues"), "is_safe", "decision",
                          F.array_join(F.array_sort(F.transform("issues", lambda i: i["phrase"])), "|").alias("phrases"))


@query("lexicon_join_documents")
def lexicon_join_documents(spark, sf_dir):
    """T5 with a lexicon table: the long words of the benchmark over every document, through the rare-gram index."""
    return _word_hits(spark, sf_dir, _word_lexicon(table(spark, sf_dir, "benchmark"), 9))


#: Share of the documents that a word of the corpus lexicon must occur in. It bounds the lexicon whatever the corpus: no more than this
#: many words for each distinct word of an average document.
LEXICON_SHARE = 500


@query("lexicon_index_documents")
def lexicon_index_documents(spark, sf_dir):
    """T5, S7 with a lexicon of many thousand phrases: the words of six letters or more that one document in ``LEXICON_SHARE`` has, over
    every document. A word counts wherever it occurs, inside longer words too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-zà-ÿ]+"))).alias("text"))
    often = words.filter(F.length("text") >= 6).groupBy("text").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * LEXICON_SHARE >= docs.count())
    found = _word_hits(spark, sf_dir, _word_lexicon(often, 6))
    return found.withColumn("phrases", F.md5("phrases"))


@query("glossary_documents")
def glossary_documents(spark, sf_dir):
    """A caller's glossary over every document, and the preferred-term map."""
    g = LJ.glossary_job(_docs(spark, sf_dir), "text", entries=CALLER_GLOSSARY)
    terms = F.map_entries(L.preferred_terms(entries=CALLER_GLOSSARY))
    return g.select("doc_id", _join(F.col("terms_used")).alias("terms_used"), _join(F.col("glossary_warnings")).alias("glossary_warnings"),
                    F.array_join(F.transform(terms, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("preferred"))


REVIEWED = "left(text, CAST(doc_id % 40 AS INT))"


@query("review_documents")
def review_documents(spark, sf_dir):
    """Documents as sources, outputs of 0 to 39 characters, some marked for review."""
    d = _docs(spark, sf_dir).withColumn("output", F.expr(REVIEWED)).withColumn("asked", F.expr("doc_id % 11 = 0"))
    r = LJ.review_job(d, "output", "text", compliance_sensitive=True, require_review=F.col("asked"), lexicon=CALLER_LEXICON,
                      entries=CALLER_GLOSSARY)
    return r.select("doc_id", "confidence", "requires_human_review", "reason", F.size("glossary_warnings").alias("n_glossary_warnings"))


def _pairs(spark, sf_dir):
    t = table(spark, sf_dir, "conversations")
    said = t.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("said"))
    answer = t.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return said.join(answer, ["conv_id", "turn"])


SAID = "CASE conv_id % 4 WHEN 0 THEN concat(said, ' stupid trash') WHEN 1 THEN concat('password=x ', said) ELSE said END"


@query("rewrite_conversations")
def rewrite_conversations(spark, sf_dir):
    """User turn -> assistant turn as rewrite; every other conversation is compliance-sensitive."""
    p = _pairs(spark, sf_dir).withColumn("said", F.expr(SAID)).withColumn("sensitive", F.expr("conv_id % 8 < 4"))
    r = LJ.rewrite_audit(p, "said", "answer", lexicon=CALLER_LEXICON, entries=CALLER_GLOSSARY, compliance_sensitive="sensitive")
    return r.select("conv_id", "turn", _join(F.col("compliance_warnings")).alias("compliance_warnings"),
                    F.size("safer_alternatives").alias("n_alternatives"), "confidence")


@query("governance_documents")
def governance_documents(spark, sf_dir):
    """A9 over documents: the audit row of each."""
    s = LJ.compliance_scan(_docs(spark, sf_dir), "text", CALLER_LEXICON)
    s = s.withColumn("confidence", L.heuristic_confidence(F.col("text"), F.size("compliance_warnings")))
    needs, _ = L.review_routing(F.col("confidence"), F.size("issues"))
    return s.select("doc_id", F.col("is_safe").alias("compliance_ok"), "confidence",
                    F.when(needs, "needs_review").otherwise("auto_approved").alias("review_status"))


# --- one loan request per order ----------------------------------------------------------------------------------------

REQUEST = """concat('Сайн байна уу. ',
  CASE WHEN o_orderkey % 8 = 1 THEN 'Надад зээл хэрэгтэй. ' ELSE concat('Би ', CAST(CAST(floor(o_totalprice / 10000) AS BIGINT) + 1 AS STRING),
    ' сая төгрөгийн ', CASE WHEN o_orderkey % 8 = 7 THEN '' WHEN o_orderkey % 3 = 0 THEN 'хэрэглээний ' WHEN o_orderkey % 3 = 1 THEN 'бизнес ' ELSE 'mortgage ' END,
    'зээл авмаар байна. ') END,
  CASE WHEN o_orderkey % 8 = 2 THEN '' ELSE concat('Хугацаа ', CAST(1 + o_custkey % 60 AS STRING), CASE WHEN o_orderkey % 2 = 0 THEN ' сар. ' ELSE ' жил. ' END) END,
  CASE WHEN o_orderkey % 8 = 3 THEN '' ELSE concat('Сарын орлого ', CAST(500000 + (o_custkey % 1000) * 1000 AS STRING), ' төгрөг. ') END,
  CASE WHEN o_orderkey % 8 = 4 THEN '' WHEN o_orderkey % 3 = 0 THEN 'Би цалинтай. ' WHEN o_orderkey % 3 = 1 THEN 'Би хувиараа. ' ELSE 'I am self-employed. ' END,
  CASE WHEN o_orderkey % 8 = 5 THEN '' WHEN o_orderkey % 4 = 0 THEN 'Барьцаа машин. ' WHEN o_orderkey % 4 = 1 THEN 'Барьцаа байр. ' WHEN o_orderkey % 4 = 2 THEN 'My property. ' ELSE 'An apartment. ' END,
  CASE WHEN o_orderkey % 8 = 6 THEN '' ELSE concat('Утас 99', lpad(CAST(o_custkey % 1000000 AS STRING), 6, '0'), '.') END)"""


def loan_requests(spark, sf_dir):
    orders = dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"))
    return orders.select("o_orderkey", F.expr(REQUEST).alias("text"))


@query("loan_extraction_orders")
def loan_extraction_orders(spark, sf_dir):
    """Every order's request; each part is missing in one of eight."""
    return _extraction_cols(LJ.extraction_job(loan_requests(spark, sf_dir), "text"), "o_orderkey")


@query("extraction_audit_orders")
def extraction_audit_orders(spark, sf_dir):
    """The redacted request and its confidence by the number of missing fields."""
    e = LJ.extraction_job(loan_requests(spark, sf_dir), "text")
    return e.select("o_orderkey", F.md5("redacted_text").alias("redacted_md5"), "confidence")


CREDIT = """SELECT o_orderkey AS idx, CAST(floor(o_totalprice) AS BIGINT) AS revenue,
  CAST(floor(o_totalprice * (30 + (o_orderkey % 8) * 9) / 100) AS BIGINT) AS expense,
  CAST(floor(o_totalprice * (o_orderkey % 11) / 10) AS BIGINT) + 1 AS debt,
  CAST(floor(o_totalprice * (o_custkey % 7) / 10) AS BIGINT) AS cash,
  CAST(floor(o_totalprice * (1 + o_orderkey % 9)) AS BIGINT) AS loan_amount, 2 + o_custkey % 59 AS term_months,
  CAST(floor(o_totalprice * (1 + o_orderkey % 9) * (8 + o_custkey % 18) / 10) AS BIGINT) AS collateral_value"""


@query("credit_tiers_orders")
def credit_tiers_orders(spark, sf_dir):
    """C1, C3, C6-C9 on figures of every order, spread over all tiers."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("credit_orders")
    m = G.metrics_v2(spark.sql(f"{CREDIT} FROM credit_orders"))
    return m.select("idx", "risk_tier", "collateral_tier", "repayment_tier", "cashflow_tier",
                    F.array_join("red_flags", ", ").alias("flags"))


# --- generated records with damage -----------------------------------------------------------------------------------------
# column -> value by (key % 40): each damage is for one rule

ENGLISH = "repeat('this answer is written in english words ', 8)"
PLAIN = "repeat('Эрсдэл өндөр байна. ', 20)"
DAMAGE_V2 = {
    "domain": {1: "'bogus'", 11: "NULL"},
    "contains_pii": {2: "true", 12: "NULL"},
    "source": {3: "'other'"},
    "assistant": {5: "concat(assistant, ' <think>')", 6: ENGLISH, 7: "left(assistant, 60)",
                  8: "replace(assistant, 'рсдэл', '-')", 10: "replace(assistant, 'Санал', '')",
                  20: "replace(assistant, 'Дутуу баримт', '')", 30: "replace(assistant, 'Шийдвэрийн үндэслэл', '')", 13: PLAIN},
}
REVERSED = 4  # records whose messages stand in the wrong order
DAMAGE_V3 = {
    "domain": {1: "'bogus'", 11: "NULL"},
    "source": {2: "'other'"},
    "contains_pii": {3: "true", 13: "NULL"},
    "user": {9: "replace(user, 'зардал', '')", 19: "replace(user, 'Орлого', '')"},
    "assistant": {4: "concat(assistant, ' </THINK>')", 5: f"concat(assistant, ' {T3.BAD_PHRASES[0]}')", 6: ENGLISH,
                  7: "left(assistant, 100)", 8: "replace(assistant, 'Ашгийн маржин', '')",
                  10: "translate(assistant, '0123456789', '9876543210')", 12: PLAIN},
}
DAMAGE_V1 = {
    "source": {1: "'other'"},
    "assistant": {2: "concat(assistant, ' 99112233')", 3: "replace(assistant, 'Та', 'чи')", 4: "replace(assistant, 'цсийн', '')",
                  5: "concat(assistant, ' Заавал батална.')"},
    "user": {6: "' '"},
}


def damage_sql(column: str, values: dict, key: str) -> str:
    return f"CASE {key} % 40 " + " ".join(f"WHEN {r} THEN {v}" for r, v in values.items()) + f" ELSE {column} END"


def damaged(df: DataFrame, damage: dict, key: str) -> DataFrame:
    return df.withColumns({c: F.expr(damage_sql(c, v, key)) for c, v in damage.items()})


def _files(df: DataFrame, extra: list[str]) -> DataFrame:
    """The layout of the files: messages and metadata."""
    return G.nested_metadata(df, keys=("domain", "source", "license_status", "allowed_usage", "contains_pii", *extra))


def v2_files(spark, sf_dir):
    rows = _files(damaged(generated(spark, sf_dir, "v2"), DAMAGE_V2, "idx"), ["numeric_example"])
    return rows.withColumn("messages", F.when(F.col("idx") % 40 == REVERSED, F.reverse("messages")).otherwise(F.col("messages")))


def v3_files(spark, sf_dir, lay_out=None):
    return _files(damaged(generated(spark, sf_dir, "v3", lay_out=lay_out), DAMAGE_V3, "gidx"), ["numeric_example"])


def gate_v2(files: DataFrame) -> DataFrame:
    """Q1 on the file layout: roles, and the last of three or more messages as the assistant's text."""
    answer = F.when(F.size("messages") >= 3, F.element_at("messages", -1)["content"]).otherwise(F.lit(""))
    flat = files.withColumn("assistant", answer).select("*", "metadata.*")
    return Q.v2_violations(flat, Q.role_sequence_ok(F.col("messages")))


def gate_v3(files: DataFrame) -> DataFrame:
    """Q2-Q4 on the file layout."""
    flat = files.withColumn("user", F.get("messages", F.lit(1))["content"]).withColumn("assistant", F.element_at("messages", -1)["content"])
    return Q.v3_violations(flat.select("*", "metadata.*"))


@query("quality_v2_damaged")
def quality_v2_damaged(spark, sf_dir):
    checked = gate_v2(v2_files(spark, sf_dir))
    return checked.select("idx", "domain", "mn_chars", "metric_terms", "first_violation", _join(F.col("violations")).alias("violations"))


@query("quality_v3_damaged")
def quality_v3_damaged(spark, sf_dir):
    checked = gate_v3(v3_files(spark, sf_dir))
    unknown = F.exists("violations", lambda v: v.startswith("missing numeric field in prompt"))  # nothing to match with
    return checked.select("gidx", "domain", "mn_chars", F.when(~unknown, F.col("metric_matches")).alias("metric_matches"), "first_violation", _join(F.col("violations")).alias("violations"))


def _counted(checked: DataFrame, order: str) -> DataFrame:
    """Q8 with counts by domain and source."""
    wrong = F.col("first_violation").isNotNull()
    each = checked.groupBy("domain", "source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(wrong).alias("bad"), F.min(F.when(wrong, F.struct(order, "first_violation"))).alias("first"))
    name = F.concat(F.coalesce("domain", F.lit("None")), F.lit("/"), F.coalesce("source", F.lit("None")), F.lit("="), F.col("n"))
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("bad"), F.lit(0)).alias("failing_rows"),
                    F.min("first")["first_violation"].alias("first_failure"),
                    F.array_join(F.array_sort(F.collect_list(name)), ";").alias("counts")).withColumn(  # a row a domain and source
        "status", F.when((F.col("failing_rows") == 0) & (F.col("rows") > 0), "PASS").otherwise("FAIL"))


@query("quality_v2_files")
def quality_v2_files(spark, sf_dir):
    """The damaged set written as JSON lines, read back with its schema, gated and summed up."""
    path = shared_path(spark, f"jsonl/v2_{uuid.uuid4().hex}")
    JS.write_jsonl(v2_files(spark, sf_dir), path, compression="gzip")
    back = JS.read_jsonl(spark, path, f"idx long, {JS.SFT_NESTED}", with_file=True)
    return _counted(gate_v2(back.filter(F.col("source_file").contains("/jsonl/v2_"))), "idx")


@query("quality_v3_sets")
def quality_v3_sets(spark, sf_dir):
    """Q8 per source as status rows: the undamaged third passes, the others don't."""
    checked = gate_v3(v3_files(spark, sf_dir)).withColumn("share", F.when(F.col("gidx") % 40 > 19, "clean").otherwise("damaged"))
    return checked.groupBy("share").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("first_violation").isNotNull()).alias("failing_rows")).withColumn(
        "status", F.when(F.col("failing_rows") == 0, "PASS").otherwise("FAIL"))


UNSAFE = ["заавал батална", "баталгаатай зөвшөөрнө", "guaranteed approval", "final approval is confirmed"]  # FIXED VALUES


@query("dataset_invariants_damaged")
def dataset_invariants_damaged(spark, sf_dir):
    """Q7 on records of which some break each invariant; ids are scanned apart from texts, since long ids are numbers."""
    v1 = damaged(generated(spark, sf_dir, "v1"), DAMAGE_V1, "idx").withColumn("id", F.format_string(T1.ID_FORMAT, F.col("idx") + 1))
    v1 = v1.withColumn("messages", F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("content")) for r in Q.ROLE_SEQUENCE]))
    v1 = v1.withColumn("messages", F.when(F.col("idx") % 40 == 7, F.reverse("messages")).otherwise(F.col("messages")))
    text, low = F.concat_ws("\n", "system", "user", "assistant", "domain", "source"), F.lower("assistant")
    known = ((F.col("source") == T1.SOURCE) & (F.col("license_status") == T1.LICENSE_STATUS)
             & (F.col("allowed_usage") == T1.ALLOWED_USAGE) & F.col("contains_pii").eqNullSafe(False))
    each = v1.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~known).alias("n_metadata"),
        F.count_if(~Q.role_sequence_ok(F.col("messages"))).alias("n_roles"),
        F.count_if(TX.has_phone(text) | TX.has_email(text) | TX.has_register(text)).alias("n_pii"),
        F.count_if(TX.has_phone(F.col("id"))).alias("n_long_ids"),
        F.count_if(~F.col("assistant").contains("Та")).alias("n_impolite"), F.count_if(~low.contains("эцсийн")).alias("n_no_final"),
        F.count_if(F.greatest(*[low.contains(p) for p in UNSAFE])).alias("n_unsafe"),
        F.count_if(F.exists("messages", lambda m: TX.is_blank(m["content"]))).alias("n_blank"))
    return each.withColumn("is_hundred", F.col("n_rows") == 100)


# --- evaluation of expected texts of all kinds -----------------------------------------------------------------------------

EXPECTED = "CASE item_id % 5 WHEN 0 THEN '' WHEN 1 THEN left(text, 6) WHEN 2 THEN NULL WHEN 3 THEN '   ' ELSE text END"


def expected_items(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.expr(EXPECTED).alias("expected"))


@query("eval_scores_expected")
def eval_scores_expected(spark, sf_dir):
    return expected_items(spark, sf_dir).select("item_id", EV.offline_score("expected").alias("offline_score"),
                                                EV.service_score("expected").alias("service_score"))


@query("eval_summary_expected")
def eval_summary_expected(spark, sf_dir):
    """A4, A5 by item kind."""
    items = expected_items(spark, sf_dir)
    s = EV.score_items(items, "item_id", "expected", "offline").withColumn("kind", F.col("item_id") % 5)
    return EV.summary(s, keys=("kind",)).drop("mean_score_raw")


@query("score_regression_expected")
def score_regression_expected(spark, sf_dir):
    """A candidate scored offline against production scored by the service; items of either side alone stay."""
    items = expected_items(spark, sf_dir)
    r = EV.regression(EV.score_items(items.filter("item_id % 7 <> 0"), "item_id", "expected", "offline"),
                      EV.score_items(items.filter("item_id % 9 <> 0"), "item_id", "expected", "service"))
    return r.select("item_id", "candidate_score", "production_score", F.round("delta", 6).alias("delta"), "regressed")


# --- reshapes, sources and gates that had no query -------------------------------------------------------------------------


@query("mongolian_filter")
def mongolian_filter(spark, sf_dir):
    """F6 as a job: documents and generated answers; Mongolian-looking rows stay, cleaned."""
    made = generated(spark, sf_dir, "v2").select(F.concat(F.lit("made-"), F.col("idx")).alias("key"),
                                                 F.expr("concat('  ', assistant, CASE idx % 3 WHEN 0 THEN repeat(' and more', 60) ELSE ' \t ' END)").alias("text"))
    docs = _docs(spark, sf_dir).select(F.concat(F.lit("doc-"), F.col("doc_id")).alias("key"), "text")
    return corpus.mongolian_filter(docs.unionByName(made)).select("key", F.md5("text").alias("text_md5"))


TAGGED = """CASE turn % 4 WHEN 0 THEN concat('<think>', left(text, 20), '</think> ', text) WHEN 1 THEN concat(text, ' </THINK>')
  WHEN 2 THEN concat(left(text, 10), '<Think a="1">x', chr(10), 'y</think>', text) ELSE text END"""


@query("strip_reasoning_tagged")
def strip_reasoning_tagged(spark, sf_dir):
    """Turns with reasoning blocks and stray tags."""
    t = table(spark, sf_dir, "conversations").withColumn("text", F.expr(TAGGED))
    return t.select("conv_id", "turn", TX.has_reasoning_tag(F.col("text")).alias("has_tag"),
                    TX.has_think_tag_regex(F.col("text")).alias("has_tag_regex"), F.md5(TX.strip_reasoning(F.col("text"))).alias("stripped_md5"))


@query("script_languages_mixed")
def script_languages_mixed(spark, sf_dir):
    """Damaged answers (Mongolian and English) by language."""
    a = damaged(generated(spark, sf_dir, "v2"), DAMAGE_V2, "idx").select(F.lit("v2").alias("lang"), F.col("assistant").alias("text"))
    return corpus.script_profile(a.unionByName(table(spark, sf_dir, "documents").select("lang", "text")))


@query("conversation_round_trip")
def conversation_round_trip(spark, sf_dir):
    """P6 both ways: turns -> messages -> turns."""
    back = CV.to_turns(CV.to_messages(table(spark, sf_dir, "conversations")))
    return back.select("conv_id", "pos", "role", F.md5("text").alias("text_md5"))


def _seeds(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").filter("role = 'user'")
    first = t.groupBy("conv_id").agg(F.min("turn").alias("turn"))
    return t.join(first, ["conv_id", "turn"]).select(F.col("conv_id").alias("id"), F.col("text").alias("prompt"))


@query("fallback_records")
def fallback_records(spark, sf_dir):
    """P3."""
    r = G.fallback_records(_seeds(spark, sf_dir))
    return r.select("id", F.md5(F.col("messages")[1]["content"]).alias("prompt_md5"), F.col("messages")[2]["content"].alias("answer"),
                    "contains_pii", "source")


@query("inference_messages")
def inference_messages(spark, sf_dir):
    """P4."""
    r = G.inference_messages(_seeds(spark, sf_dir))
    return r.select("id", F.col("messages")[0]["content"].alias("system"), F.md5(F.col("messages")[1]["content"]).alias("user_md5"))


@query("preference_pairs")
def preference_pairs(spark, sf_dir):
    """P10: generated answers as chosen, their prompts as rejected; some pairs lack a field."""
    v1 = generated(spark, sf_dir, "v1").select("idx", F.expr("CASE WHEN idx % 17 = 0 THEN '' ELSE assistant END").alias("chosen"),
                                               F.col("user").alias("rejected"), F.expr("CASE WHEN idx % 13 <> 0 THEN domain END").alias("rationale"),
                                               F.expr("CASE WHEN idx % 19 <> 0 THEN domain ELSE '' END").alias("compliance_category"))
    p = GT.preference_pair_gate(v1)
    return p.select("idx", F.array_join("missing_fields", ",").alias("missing_fields"), "chosen_safe", "rejected_unsafe", "pair_ok")


TRANSLATE_SYSTEM = ("You are a Mongolian-native Qwen translation model. Preserve meaning, use preferred "  # FIXED VALUES
                    "financial/legal terminology, and avoid promising loan approval.")
REWRITE_SYSTEM = ("Rewrite lending text in safe, polite Mongolian unless another target language is requested. "
                  "Do not promise approval; include final review disclaimers where relevant.")
LANGUAGES, DOMAINS = ("mn", "en", "auto"), ("general", "finance", "legal", "lending", "borrower_support")
TONES, SEVERITIES = ("neutral", "polite", "borrower_friendly", "formal", "legal"), ("low", "medium", "high")


def _cycle(values, key) -> F.Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (key % len(values)).cast("int"))


@query("translate_prompts")
def translate_prompts(spark, sf_dir):
    """The translation prompt of each user turn."""
    t, k = table(spark, sf_dir, "conversations").filter("role = 'user'"), F.col("conv_id")
    prompt = F.concat(F.lit("Translate from "), _cycle(LANGUAGES, k), F.lit(" to "), _cycle(LANGUAGES[:2], k + 1), F.lit(". Domain: "),
                      _cycle(DOMAINS, k), F.lit(". Tone: "), _cycle(TONES, k + F.col("turn")), F.lit(".\n\n"), F.col("text"))
    return t.select("conv_id", "turn", F.lit(TRANSLATE_SYSTEM).alias("system"), prompt.alias("prompt"))


@query("rewrite_prompts")
def rewrite_prompts(spark, sf_dir):
    """The rewriting prompt of each user turn, with the safer text where one is detected."""
    p = _pairs(spark, sf_dir).withColumn("said", F.expr(SAID))
    s, k = LJ.compliance_scan(p, "said", CALLER_LEXICON), F.col("conv_id")
    prompt = F.concat(F.lit("Target language: "), _cycle(LANGUAGES[:2], k), F.lit(". Tone: "), _cycle(TONES, k), F.lit(".\nText: "),
                      F.coalesce("safer_text", "said"))
    return s.select("conv_id", "turn", F.lit(REWRITE_SYSTEM).alias("system"), prompt.alias("prompt"))


REQUEST_FIELDS = """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'mn' WHEN 1 THEN 'en' WHEN 2 THEN 'auto' ELSE 'ru' END AS language,
  CASE o_orderkey % 6 WHEN 0 THEN 'general' WHEN 1 THEN 'finance' WHEN 2 THEN 'legal' WHEN 3 THEN 'lending' WHEN 4 THEN 'borrower_support' END AS domain,
  CASE o_custkey % 3 WHEN 0 THEN 'polite' WHEN 1 THEN 'formal' ELSE 'rude' END AS tone,
  CASE o_custkey % 5 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'huge' END AS severity,
  CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE o_orderstatus END AS text, (o_custkey % 13) / CAST(10 AS DOUBLE) AS score"""


@query("field_domains")
def field_domains(spark, sf_dir):
    """enums, minimum length and the [0, 1] range on one request per order."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("request_orders")
    r = spark.sql(f"{REQUEST_FIELDS} FROM request_orders")
    bad = GT.field_domain_violations({
        "language": F.col("language").isin(*LANGUAGES), "domain": F.col("domain").isin(*DOMAINS), "tone": F.col("tone").isin(*TONES),
        "severity": F.col("severity").isin(*SEVERITIES), "text": F.length("text") >= 1, "score": F.col("score").between(0, 1)})
    return r.select("o_orderkey", F.array_join(bad, ",").alias("violations"))


@query("generation_guard")
def generation_guard(spark, sf_dir):
    """F8: both size guards on sets of orders of very different sizes."""
    sets = table(spark, sf_dir, "orders").groupBy((F.col("o_orderkey") % 1000 < 3).alias("few"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return sets.select("few", "o_orderstatus", "n", GT.size_guard(F.col("n")).alias("prep_guard"), GT.generation_guard(F.col("n")).alias("v2_guard"))


@query("domain_quota_sets")
def domain_quota_sets(spark, sf_dir):
    """Q6 as stated: sets of exactly 1500, 1350 or 150 records have fixed counts by domain; others aren't checked."""
    v3 = G.v3_keys(table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("gidx")))
    sets = v3.withColumn("set_id", F.floor((F.col("gidx") - 1) / T3.CYCLE)).filter("gidx % 2000 <> 0").withColumn(
        "part", F.when(F.col("gidx") % 10 == 9, "b").otherwise("a"))
    counts = sets.groupBy("set_id", "part", "domain").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("set_id", "part").agg(F.sum("n").alias("total"))
    return (counts.join(totals, ["set_id", "part"]).join(F.broadcast(Q.quota_table(spark)), ["total", "domain"], "left")
            .select("set_id", "part", "domain", "total", "n", "expected", (F.col("expected").isNull() | (F.col("n") == F.col("expected"))).alias("matches")))


@query("slot_usage")
def slot_usage(spark, sf_dir):
    """The slot vocabularies as a table, with how often the v1 index uses each value."""
    v1 = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("idx"))
    from ..functions.templating import pick
    rows = [(d, slot, o, str(x)) for d in T1.DOMAINS for slot, (v, _m, _o) in T1.SLOTS[d].items() for o, x in enumerate(T1.VOCABS[v])]
    vocab = spark.createDataFrame(rows, "domain string, slot string, ord int, value string")
    place = [F.struct(F.lit(d).alias("domain"), F.lit(slot).alias("slot"), F.pmod(F.col("idx") * m + o, F.lit(len(T1.VOCABS[v]))).cast("int").alias("ord"))
             for d in T1.DOMAINS for slot, (v, m, o) in T1.SLOTS[d].items()]
    used = (v1.withColumn("own", pick(T1.DOMAINS, F.col("idx"))).select("own", F.inline(F.array(*place))).filter("own = domain")
            .groupBy("domain", "slot", "ord").agg(F.count(F.lit(1)).alias("n")))
    return vocab.join(used, ["domain", "slot", "ord"], "left").select("domain", "slot", "ord", "value", F.coalesce("n", F.lit(0)).alias("n"))


@query("lexicon_usage")
def lexicon_usage(spark, sf_dir):
    """The lexicon as a table, with the number of generated records each phrase occurs in."""
    found = generated(spark, sf_dir, "v1", lambda d: LJ.compliance_scan(d, "user")).select(F.explode("issues").alias("i")).select("i.phrase")
    counts = found.groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
    return DM.lexicon_table(spark).join(counts, "phrase", "left").select("ord", "category", "phrase", "severity", F.coalesce("n", F.lit(0)).alias("n"))


@query("benchmark_files")
def benchmark_files(spark, sf_dir):
    """Items with the general template's metadata written as JSON lines and read back with the item schema."""
    items = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("general-mn-"), F.col("item_id")).alias("id"), F.lit("fluency").alias("task"), F.col("text").alias("input"),
        F.expr(EXPECTED).alias("expected"), F.lit("general").alias("domain"))
    path = shared_path(spark, f"jsonl/items_{uuid.uuid4().hex}")
    JS.write_jsonl(DM.attach_template_metadata(items, DM.GENERAL_TEMPLATE_METADATA), path)
    back = JS.read_jsonl(spark, path, JS.BENCHMARK_ITEM, with_file=True)
    return back.select("id", "task", F.md5("input").alias("input_md5"), "expected", "domain",
                       F.col("metadata")["license"].alias("license"), F.col("metadata")["human_review_required"].alias("human_review_required"),
                       F.col("source_file").endswith(".json").alias("has_file"))


@query("summary_files")
def summary_files(spark, sf_dir):
    """Counts by source written as a summary file and read back."""
    path = shared_path(spark, f"jsonl/summary_{uuid.uuid4().hex}")
    JS.write_summary(table(spark, sf_dir, "documents"), "source", path)
    return spark.read.schema("source string, n long").json(path)


@query("prompt_lists")
def prompt_lists(spark, sf_dir):
    """User turns written as JSON lists, one a conversation, and read back as prompts."""
    t = table(spark, sf_dir, "conversations").filter("role = 'user'")
    lists = CV.to_messages(t).select("conv_id", F.to_json(F.struct(F.transform("messages", lambda m: m["content"]).alias("prompts"))).alias("value"))
    path = shared_path(spark, f"jsonl/prompts_{uuid.uuid4().hex}")
    lists.select("value").write.text(path)
    return JS.read_prompt_list(spark, path, wholetext=False).select("pos", F.md5("prompt").alias("prompt_md5"))


@query("rights_flags")
def rights_flags(spark, sf_dir):
    """F3 with flags as text and gold translations, F4 on records that declare personal data."""
    d = _docs(spark, sf_dir).withColumn("contains_raw_customer_pii", F.expr("CASE doc_id % 5 WHEN 0 THEN 'yes' WHEN 1 THEN '' END")) \
        .withColumn("google_translate_gold", F.expr("CASE doc_id % 7 WHEN 0 THEN true WHEN 1 THEN false END")) \
        .withColumn("contains_pii", F.expr("CASE doc_id % 3 WHEN 0 THEN true WHEN 1 THEN false END"))
    d = d.withColumn("kept", GT.pii_kept(d))
    accepted, rejected = GT.declared_pii_gate(d)
    return d.groupBy("kept").agg(F.count(F.lit(1)).alias("n"), rejected.alias("rejected"))
