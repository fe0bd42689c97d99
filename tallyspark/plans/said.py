"""Registered queries over conversations that say something about a loan, and over sets that break the size rules.

The given turns hold no loan figure, no lexicon phrase and little Mongolian, so every outcome of the chat rules would be the same. Here each turn keeps
its text and gets a sentence by conversation and turn: users give fields, one or several, in later turns again; answers hold
phrases of the lexicon. The expressions are plain SQL for both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as V
from ..operators import conversation as CV
from ..operators import gates as GT
from ..operators import generate as G
from ..operators import lending_jobs as LJ
from ..operators import quality as Q
from ..operators import templates_v1 as T1
from ..operators import templates_v3 as T3
from ..sources import dims as DM
from ..sources.tables import table
from .registry import CHAT_SYSTEM, query

#: What users say; by (conversation + 3 turns) mod their number, the last three say nothing.
FIELDS = ["Би 10 сая төгрөгийн хэрэглээний зээл авмаар байна.", "Хугацаа 12 сар.", "Сарын орлого 900000 төгрөг.", "Би цалинтай.", "Барьцаа машин.",
          "Утас 99112233.", "Би 5 сая төгрөгийн бизнес зээл авмаар байна. Хугацаа 2 жил. Сарын орлого 1500000 төгрөг. Би хувиараа. Барьцаа байр. Утас 88112233."]


def said_sql(quote) -> str:
    """The turns' texts."""
    fields = " ".join(f"WHEN {i} THEN {quote(x)}" for i, x in enumerate(FIELDS))
    phrases = " ".join(f"WHEN {i} THEN {quote(r[2])}" for i, r in enumerate(V.lexicon_rows()))
    user = f"concat(CASE (conv_id + 3 * turn) % {len(FIELDS) + 3} {fields} ELSE '' END, CASE WHEN conv_id % 3 = 0 THEN text ELSE '' END, ' ')"
    answer = f"concat(text, ' ', CASE (3 * conv_id + turn) % {len(V.lexicon_rows()) + 9} {phrases} ELSE '' END)"
    return f"CASE role WHEN 'user' THEN {user} WHEN 'assistant' THEN {answer} ELSE text END"


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def said(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.expr(said_sql(_quote)).alias("text"))


@query("chat_audit_said")
def chat_audit_said(spark, sf_dir):
    """Language, confidence, issues and missing fields of conversations that differ in all of them."""
    a = CV.chat_audit(said(spark, sf_dir))
    return a.select("conv_id", "language", "confidence", F.size("issues").alias("n_issues"),
                    F.array_join("missing_application_fields", ",").alias("missing_application_fields"))


@query("chat_prompts_said")
def chat_prompts_said(spark, sf_dir):
    """The system prompt asks for the fields that the conversation lacks."""
    missing = F.col("missing_application_fields")
    listed = F.when(F.size(missing) > 0, F.array_join(missing, ", ")).otherwise(F.lit("none"))
    return CV.chat_audit(said(spark, sf_dir)).select("conv_id", F.concat(F.lit(CHAT_SYSTEM), listed, F.lit(".")).alias("system_prompt"))


@query("context_fields_said")
def context_fields_said(spark, sf_dir):
    """For each field, in how many conversations it is given and in how many it is missing."""
    a = CV.chat_audit(said(spark, sf_dir)).select("missing_application_fields")
    field = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.array_contains("missing_application_fields", f).alias("missing")) for f in V.EXTRACTION_FIELDS]))
    return a.select(field.alias("f")).groupBy("f.field").agg(F.count_if(~F.col("f.missing")).alias("n_given"), F.count_if(F.col("f.missing")).alias("n_missing"))


@query("lexicon_usage_said")
def lexicon_usage_said(spark, sf_dir):
    """Each phrase of the lexicon table and how many turns it occurs in."""
    found = LJ.compliance_scan(said(spark, sf_dir), "text").select(F.explode("issues").alias("i")).groupBy("i.phrase").agg(F.count(F.lit(1)).alias("n"))
    return DM.lexicon_table(spark).join(found, "phrase", "left").select("ord", "category", "phrase", "severity", F.coalesce("n", F.lit(0)).alias("n"))


GIVEN = {"domain": "CASE conv_id % 4 WHEN 0 THEN 'legal' WHEN 1 THEN 'finance' END", "language": "CASE conv_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'mn' END",
         "contains_pii": "CASE conv_id % 5 WHEN 0 THEN true WHEN 1 THEN false END"}


@query("teacher_records_given")
def teacher_records_given(spark, sf_dir):
    """Every user turn as a seed; domain, language and flag are given or take their defaults."""
    t = said(spark, sf_dir).filter("role = 'user'")
    seeds = t.select(F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("text").alias("prompt"), *[F.expr(e).alias(c) for c, e in GIVEN.items()])
    r = G.teacher_records(seeds)
    return r.select("id", F.md5(F.col("messages")[2]["content"]).alias("assistant"), "domain", "language", "contains_pii", "human_review_required")


@query("preference_pairs_said")
def preference_pairs_said(spark, sf_dir):
    """P10: an answer as chosen, the same with a promise, or another phrase, as rejected; chosen answers are unsafe, too."""
    t = said(spark, sf_dir).filter("role = 'assistant'").select(
        "conv_id", "turn", F.col("text").alias("chosen"), F.expr("CASE WHEN conv_id % 2 = 0 THEN concat(text, ' guaranteed approval') ELSE text END").alias("rejected"),
        F.expr("CASE WHEN turn % 4 = 1 THEN 'tone' END").alias("rationale"), F.lit("promise").alias("compliance_category"))
    return GT.preference_pair_gate(t).select("conv_id", "turn", F.array_join("missing_fields", ",").alias("missing_fields"), "chosen_safe", "rejected_unsafe", "pair_ok")


# --- sets that break the size rules ----------------------------------------------------------------------------------------------

#: By set: as it must be; some records of another domain; a domain lacking; the training part.
V3_KEPT = "CASE set_id % 4 WHEN 2 THEN domain <> 'missing_documents_request' WHEN 3 THEN gidx % 10 <> 0 ELSE true END"
V3_DOMAIN = "CASE WHEN set_id % 4 = 1 AND gidx % 1500 < 7 THEN 'missing_documents_request' ELSE domain END"


@query("domain_rules_sets")
def domain_rules_sets(spark, sf_dir):
    """Q5, Q6: runs of 1500 records as sets, some of which lack a domain or have wrong counts."""
    v3 = G.v3_keys(table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("gidx")))
    sets = v3.withColumn("set_id", F.floor((F.col("gidx") - 1) / T3.CYCLE)).filter(F.expr(V3_KEPT)).withColumn("domain", F.expr(V3_DOMAIN))
    return Q.domain_rules(sets.select("set_id", "domain"), "set_id", [d for d, _ in T3.DOMAIN_QUOTAS])


V1_KEPT = "set_id % 4 <> 1 OR idx % 500 <> 7"
V1_DOMAIN = "CASE WHEN set_id % 4 = 2 AND idx % 500 < 3 THEN 'other' ELSE domain END"


@query("size_rules_sets")
def size_rules_sets(spark, sf_dir):
    """Q7: runs of 500 records as sets: whole ones, short ones, and some with a domain that isn't known."""
    v1 = G.attach(G.v1_keys(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("idx"))), G.content_v1(spark)).select("idx", "domain")
    sets = v1.withColumn("set_id", F.floor(F.col("idx") / 500)).filter(V1_KEPT).withColumn("domain", F.expr(V1_DOMAIN))
    return Q.size_rules(sets.select("set_id", "domain"), "set_id", T1.DOMAINS)
