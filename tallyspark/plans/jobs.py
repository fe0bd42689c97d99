"""Registered queries: dictionaries by row, totals over portfolios and records, equality of sets, and the stream's three outputs."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import compare_sets as CS
from ..operators import credit_jobs as CJ
from ..operators import generate as G
from ..operators import lending_jobs as LJ
from ..operators import quality as Q
from ..session import shared_path
from ..sources.tables import table
from ..streaming import fanout as FO
from .records import CALLER_LEXICON, CREDIT, DAMAGE_V1, damaged, loan_requests
from .registry import _join, generated, query

# --- T9, S6: a glossary for each row ------------------------------------------------------------------------------------

#: (glossary_id, ord, term, preferred): one that changes default terms, one with new terms, one with both.
GLOSSARIES = [
    ("changed", 0, "loan", "credit line"), ("changed", 1, "fee", "charge"), ("changed", 2, "approval", "consent"),
    ("new", 0, "license", "permit"), ("new", 1, "Password", "passcode"), ("new", 2, "the", "that"),
    ("both", 0, "application", "form"), ("both", 1, "stupid", "unwise"), ("both", 2, "loan", "advance"), ("both", 3, "email", "mail"),
]
#: Which glossary a document asks for: three that exist, one that doesn't, none.
ASKED = "CASE doc_id % 5 WHEN 0 THEN 'changed' WHEN 1 THEN 'new' WHEN 2 THEN 'both' WHEN 3 THEN 'unknown' END"


@query("glossary_by_row")
def glossary_by_row(spark, sf_dir):
    """Documents checked by the glossary that each names."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("glossary_id", F.expr(ASKED))
    found = LJ.glossary_by_row(docs, "text", spark.createDataFrame(GLOSSARIES, "glossary_id string, ord int, term string, preferred string"))
    return found.select("doc_id", "glossary_id", _join(F.col("terms_used")).alias("terms_used"), _join(F.col("glossary_warnings")).alias("glossary_warnings"))


# --- C11, A1: totals -----------------------------------------------------------------------------------------------------


@query("portfolio_cube")
def portfolio_cube(spark, sf_dir):
    """C11: customers by segment, tier and recommendation, with every total."""
    facts = CJ.customer_facts(*[table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem")])
    return CJ.risk_cube(CJ.customer_risk(facts))


@query("portfolio_flags")
def portfolio_flags(spark, sf_dir):
    """Red flags of every order's loan by sector (the order's priority) and tier, with totals."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("flag_orders")
    return CJ.flag_rollup(G.metrics_v2(spark.sql(f"{CREDIT}, o_orderpriority AS sector FROM flag_orders")))


@query("records_rollup")
def records_rollup(spark, sf_dir):
    """A1: the records of the three generated sets by source and domain, with totals."""
    sets = [generated(spark, sf_dir, v).select("source", "domain") for v in ("v1", "v2", "v3")]
    return Q.count_rollup(reduce(DataFrame.unionByName, sets))


# --- Q5, Q7: equality of sets ----------------------------------------------------------------------------------------------


def _pair(spark, sf_dir):
    """The v1 set and a damaged copy in which some records stand twice and some are gone."""
    whole = generated(spark, sf_dir, "v1").select("idx", "domain", "source", "user", "assistant")
    copies = F.expr("CASE idx % 50 WHEN 30 THEN 2 WHEN 31 THEN 0 ELSE 1 END")
    other = damaged(whole, DAMAGE_V1, "idx").withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies)))
    short = lambda d: d.select("domain", "source", F.md5(F.concat_ws("|", "user", "assistant")).alias("texts"))
    return short(whole), short(other)


@query("set_difference")
def set_difference(spark, sf_dir):
    """Q7: records missing from, and surplus in, a damaged set, with how many copies."""
    return CS.set_difference(*_pair(spark, sf_dir))


@query("set_equality")
def set_equality(spark, sf_dir):
    """Q7: the damaged set against the whole one, and the whole one against itself in other partitions."""
    whole, other = _pair(spark, sf_dir)
    return CS.equality({"damaged": (whole, other), "same": (whole, whole.repartition(7, "texts"))})


# --- T1, T5, T19 on a stream -----------------------------------------------------------------------------------------------

SAID = "concat(text, CASE o_orderkey % 9 WHEN 4 THEN ' You stupid idiot, all rights reserved.' WHEN 7 THEN ' password=x AKIA1' ELSE '' END)"


@query("stream_fanout")
def stream_fanout(spark, sf_dir):
    """Loan requests as a stream of files in several batches; redacted text, issues and fields of each from the three
    outputs. One batch is delivered again, as after a failure."""
    said = loan_requests(spark, sf_dir).select("o_orderkey", F.expr(SAID).alias("text"))
    name = f"fanout_{uuid.uuid4().hex[:12]}"
    source = shared_path(spark, f"streams/{name}_source")
    said.repartition(6, "o_orderkey").write.parquet(source)
    schema = "o_orderkey bigint, text string"
    folder = FO.run_fanout(spark, source, schema, "o_orderkey", "text", name, CALLER_LEXICON, max_files_per_trigger=2)
    made = FO.outputs("o_orderkey", "text", CALLER_LEXICON)
    FO.write_batch(_kept(spark, folder, schema), 0, folder, made)
    like = {n: f(spark.createDataFrame([], schema)) for n, f in made.items()}
    out = {n: FO.read_output(spark, folder, n, like[n]) for n in made}
    issues = out["issues"].groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n_issues"), _join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "phrase"))), lambda i: i["phrase"])).alias("phrases"))
    return (out["redacted"].join(out["fields"], "o_orderkey").join(issues, "o_orderkey", "left")
            .select("o_orderkey", F.md5("redacted_text").alias("redacted_md5"), "loan_amount", "loan_term_months", "employment_status",
                    F.size("missing_fields").alias("n_missing"), F.coalesce("n_issues", F.lit(0)).alias("n_issues"), F.coalesce("phrases", F.lit("")).alias("phrases")))


def _kept(spark, folder: str, schema: str) -> DataFrame:
    """What batch 0 was, from a copy: its own folder is about to be overwritten."""
    copy = f"{folder}/repeated"
    spark.read.schema(schema).parquet(f"{folder}/input/batch=0").write.parquet(copy)
    return spark.read.schema(schema).parquet(copy)
