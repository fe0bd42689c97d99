"""Registered queries that go through files: line numbers, fail-fast checks, partitioned sets, preparation and the store of results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import conversation as CV
from ..operators import corpus
from ..operators import fail_fast as FF
from ..operators import prepare as PR
from ..operators import quality as Q
from ..operators import result_store as RS
from ..session import shared_path
from ..sources import jsonl as JS
from ..sources import lines as LN
from ..sources.tables import table
from .records import gate_v3, v3_files
from .registry import generated, query

LINE_FILES = 8
#: Splits small enough that each file of the small tables has several.
SPLIT = 64 << 10


def fresh(spark, label: str) -> str:
    return shared_path(spark, f"{label}/{uuid.uuid4().hex}")


def write_lines(rows: DataFrame, path: str) -> None:
    """``rows`` (file, ord, lines: array): a folder a file, its lines in the order of ``ord``."""
    each = rows.select("file", "ord", F.posexplode("lines").alias("seq", "value"))
    (each.repartition(F.col("file")).sortWithinPartitions("file", "ord", "seq").select("file", "value")
         .write.partitionBy("file").text(path))


def with_blanks(record, when):
    """A record's line, with an empty line before and a line of blanks after it ``when`` that holds."""
    return F.when(when, F.array(F.lit(""), record, F.lit(" \t "))).otherwise(F.array(record))


FILE_NO = r"/file=(\d+)/"


@query("jsonl_lines")
def jsonl_lines(spark, sf_dir):
    """S3: documents as JSON lines with blank ones between, read back in small splits with file and line."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    path = fresh(spark, "lines")
    write_lines(d.select(F.lpad((F.col("doc_id") % LINE_FILES).cast("string"), 2, "0").alias("file"), F.col("doc_id").alias("ord"),
                         with_blanks(F.to_json(F.struct("doc_id", "source", "text")), F.col("doc_id") % 5 == 0).alias("lines")), path)
    back = LN.read_jsonl_lines(spark, path, "doc_id long, source string, text string", LN.split_size(spark, path, SPLIT))
    return back.select("doc_id", F.regexp_extract("file", FILE_NO, 1).alias("file"), "line", "source", F.length("text").alias("n_chars"))


FAIL_FILES = 16
#: Where the damaged rows of each set are: a share of the files, none at all, all.
FAIL_SETS = {"early": "true", "late": f"gidx % {FAIL_FILES} >= 11 OR gidx % 40 > 19", "clean": "gidx % 40 > 19"}


@query("quality_v3_first_failure")
def quality_v3_first_failure(spark, sf_dir):
    """Q8, S3: three sets in files, checked until the first bad row: message with file and line, and how many files were read."""
    file = F.lpad((F.col("gidx") % FAIL_FILES).cast("string"), 2, "0")
    lines = with_blanks(F.lit(None).cast("string"), F.col("gidx") % 5 == 0)  # null: the record's own line
    out = None
    for name, where in FAIL_SETS.items():
        path = fresh(spark, f"failfast-{name}")
        # keys are dealt to files and sorted before they have texts, and kept: texts take part in no exchange or sort, and files are compressed
        lay_out = lambda keys: (keys.filter(where).select("*", file.alias("file"), F.posexplode(lines).alias("seq", "line"))
                                .repartition(F.col("file")).sortWithinPartitions("file", "gidx", "seq").checkpoint())
        rows = v3_files(spark, sf_dir, lay_out)
        record = F.to_json(F.struct(*[c for c in rows.columns if c not in ("file", "seq", "line")]))
        (rows.select("file", F.coalesce("line", record).alias("value"))
             .write.partitionBy("file").option("compression", "gzip").text(path))
        found = FF.first_failure(spark, path, f"gidx long, {JS.SFT_NESTED}", gate_v3, Q.quota_for_size, split_bytes=4 << 20, deal=True)
        message = F.regexp_replace("message", r"^FAIL .*/file=(\d+)/[^:]*:", r"FAIL $1:")
        one = found.select(F.lit(name).alias("name"), "status", message.alias("message"), F.regexp_extract("file", FILE_NO, 1).alias("file"), "line",
                           "rows", F.array_join(F.array_sort(F.transform(F.map_entries("domains"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
                           .alias("domains"), "files_read")
        out = one if out is None else out.unionByName(one)
    return out


# --- partitioned sets (S4), preparation (A8), results kept between runs (X4) ---------------------------------------------

RERUN = "credit_memo_numeric"


@query("jsonl_partitioned")
def jsonl_partitioned(spark, sf_dir):
    """S4 by split and domain: the v3 set, then a rerun for one domain's training part with other texts; all of it read back."""
    split = F.when(F.col("gidx") % 10 == 0, "val").otherwise("train")
    rows = generated(spark, sf_dir, "v3").select("gidx", split.alias("split"), "domain", "assistant")
    path = fresh(spark, "partitioned")
    JS.write_jsonl_partitioned(rows, path, ["split", "domain"], "gzip")  # as plain text, the set is many times the orders it is made from
    again = rows.filter((F.col("domain") == RERUN) & (F.col("split") == "train") & (F.col("gidx") % 2 == 0))
    JS.write_jsonl_partitioned(again.withColumn("assistant", F.concat(F.lit("2: "), "assistant")), path, ["split", "domain"], "gzip")
    back = JS.read_jsonl_partitioned(spark, path, "gidx long, assistant string", "split string, domain string")
    return back.select("gidx", "split", "domain", F.md5("assistant").alias("assistant"))


def conversation_records(spark, sf_dir) -> DataFrame:
    """Conversations as records: messages and whether a turn holds personal data."""
    turns = table(spark, sf_dir, "conversations")
    flagged = corpus.pii_flags(turns).withColumn("_pii", F.col("has_phone") | F.col("has_email") | F.col("has_register"))
    pii = flagged.groupBy("conv_id").agg(F.bool_or("_pii").alias("contains_pii"))
    return CV.to_messages(turns).join(pii, "conv_id")


@query("sft_prep_files")
def sft_prep_files(spark, sf_dir):
    """Conversations prepared into training and validation files; the members as the files hold them."""
    path = fresh(spark, "prepared")
    guard = PR.prepare_sft(spark, conversation_records(spark, sf_dir), path, "conv_id").first()["guard"]
    schema = "conv_id long, contains_pii boolean, messages array<struct<turn:bigint,role:string,content:string>>"
    back = (JS.read_jsonl_partitioned(spark, path, schema, "split string") if guard == "ok"
            else spark.createDataFrame([], f"{schema}, split string"))  # a refused set has no files
    chars = F.aggregate("messages", F.lit(0).cast("bigint"), lambda n, m: n + F.length(m["content"]))
    return back.select("split", "conv_id", "contains_pii", F.size("messages").alias("n_messages"), chars.alias("n_chars"))


@query("sft_prep_counts")
def sft_prep_counts(spark, sf_dir):
    """The summary of three runs: as it is, with personal data allowed, and a dry run of the first."""
    records = conversation_records(spark, sf_dir)
    out = None
    for name, options in (("run", {}), ("allow_pii", {"allow_pii": True}), ("dry_run", {"dry_run": True})):
        one = PR.prepare_sft(spark, records, fresh(spark, f"prepared-{name}"), "conv_id", **options).drop("train_output", "val_output")
        one = one.withColumn("run", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("result_store_runs")
def result_store_runs(spark, sf_dir):
    """Three calls with one store: nine tenths of the documents, the same again, all of them. Each document's result, the call
    that computed it, and how many keys each call had to compute."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    store = RS.ResultStore(spark, fresh(spark, "store"), "string")
    redacted = lambda c: F.md5(TX.redact_pii(c))
    most = docs.filter("doc_id % 10 <> 0")
    _, first = store.get_or_compute(most, "redact", "text", redacted, "result")
    _, second = store.get_or_compute(most, "redact", "text", redacted, "result")
    found, third = store.get_or_compute(docs, "redact", "text", redacted, "result")
    call = store.results().select("cache_key", (F.substring("batch", 1, 6).cast("int") * 2 + 1).alias("call"))
    return found.join(call, "cache_key", "left").select(
        "doc_id", "cache_key", "result", "call", F.lit(f"{first},{second},{third}").alias("computed"))
