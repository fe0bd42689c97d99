"""JSONL sources and sinks (S1-S4, S8-S10) with explicit schemas.

``spark.read.json`` with a schema and FAILFAST: no inference pass, malformed
lines raise, blank lines are skipped. Output is written with ``write.json`` in
overwrite mode (one directory of part files per dataset).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE = "struct<role:string,content:string>"
SFT_FLAT = (f"id string, messages array<{MESSAGE}>, domain string, source string, license_status string, "
            "allowed_usage string, contains_pii boolean")
SFT_NESTED = (f"id string, messages array<{MESSAGE}>, metadata struct<domain:string,source:string,"
              "license_status:string,allowed_usage:string,contains_pii:boolean,numeric_example:boolean,"
              "metrics_expected:boolean>")
SEED_PROMPT = "id string, prompt string, domain string, language string, contains_pii boolean"
TRANSLATION_PAIR = ("source_text string, target_text string, source_url string, license_status string, "
                    "retrieval_date string, allowed_usage string")
BENCHMARK_ITEM = "id string, task string, input string, expected string, domain string, metadata map<string,string>"
RAW_DOCUMENT = ("text string, source_url string, license_status string, retrieval_date date, "
                "allowed_usage string, pii_status string, review_status string")


def read_jsonl(spark: SparkSession, path: str, schema: str, with_file: bool = False) -> DataFrame:
    """schema'd JSONL scan; ``with_file`` adds the source file path (S3)."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if with_file:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


def write_jsonl(df: DataFrame, path: str, compression: str | None = None) -> None:
    """UTF-8 JSON lines, overwrite, parent folders created (optionally compressed;
    readers detect the codec from the file extension)."""
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def write_jsonl_partitioned(df: DataFrame, path: str, by: list[str], compression: str | None = None) -> None:
    """S4 by split, domain and such: JSON lines in a folder for each value of ``by``. A rerun replaces the folders that it has
    rows for and leaves the others; readers that filter on ``by`` open the folders they need only.

    Rows go to the files from the tasks they are in, so a value that holds most rows is written by many tasks."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def read_jsonl_partitioned(spark: SparkSession, path: str, schema: str, by: str) -> DataFrame:
    """The records of a partitioned set: ``schema`` for the lines, ``by`` (as in ``split string, domain string``) for the folders."""
    return spark.read.schema(f"{schema}, {by}").option("mode", "FAILFAST").json(path)


def read_prompt_list(spark: SparkSession, path: str, wholetext: bool = True) -> DataFrame:
    """A JSON list of strings, or an object with a ``prompts`` list, per file (or per line); every item a
    non-blank string, else the job fails (``assert_true``)."""
    from ..functions.text import is_blank
    raw = spark.read.text(path, wholetext=wholetext)
    as_list = F.from_json("value", "array<string>")
    as_obj = F.from_json("value", "struct<prompts:array<string>>").getField("prompts")
    prompts = raw.select(F.coalesce(as_list, as_obj).alias("prompts"))
    # the assertions are folded into the output columns so the optimizer cannot prune them
    checked = prompts.select(F.coalesce(
        F.assert_true(F.col("prompts").isNotNull(), "prompts must be a JSON list of non-empty strings").cast("array<string>"),
        F.col("prompts")).alias("prompts"))
    items = checked.select(F.posexplode("prompts").alias("pos", "prompt"))
    return items.select("pos", F.coalesce(F.assert_true(~is_blank(F.col("prompt")), "empty prompt").cast("string"),
                                          F.col("prompt")).alias("prompt"))


def write_summary(df: DataFrame, key: str, path: str) -> None:
    """The counts by ``key``, a JSON line a value, however many values there are."""
    write_jsonl(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")), path)


def summary_row(df: DataFrame, key: str) -> DataFrame:
    """S10 for a key of few values: one row with a ``{value: count}`` map for ``key`` and the total."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.sum("n").alias("rows"),
                      F.map_from_entries(F.collect_list(F.struct(F.col(key).cast("string"), "n"))).alias(f"{key}_counts"))
