"""T1, T5 and T19 on one stream: each message gives a redacted log line, its compliance issues and its loan fields.

``foreachBatch`` reads a micro-batch once into the shared folder and writes three outputs. Each is a folder a batch, named by the batch's id and
overwritten: a batch that Spark repeats after a failure replaces what its first attempt left, so every message stands once in each
output. The rules are the same Columns as in the batch jobs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import lending_jobs as LJ
from ..session import shared_path
from ..sources.tables import dealt


def redacted_log(messages: DataFrame, key: str, text_col: str) -> DataFrame:
    return messages.select(key, TX.redact_pii(F.col(text_col)).alias("redacted_text"))


def issue_rows(messages: DataFrame, key: str, text_col: str, lexicon=None) -> DataFrame:
    """One row an issue, with its place in the message's list."""
    scanned = LJ.compliance_scan(messages.select(key, text_col), text_col, lexicon)
    return scanned.select(key, "decision", F.posexplode("issues").alias("pos", "issue")).select(
        key, "decision", "pos", "issue.category", "issue.phrase", "issue.severity")


def field_rows(messages: DataFrame, key: str, text_col: str) -> DataFrame:
    return LJ.extraction_job(messages.select(key, text_col), text_col).drop(text_col, "redacted_text")


def outputs(key: str, text_col: str, lexicon=None) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """The three outputs, for a batch or a whole table."""
    return {"redacted": lambda m: redacted_log(m, key, text_col), "issues": lambda m: issue_rows(m, key, text_col, lexicon),
            "fields": lambda m: field_rows(m, key, text_col)}


def write_batch(messages: DataFrame, batch_id: int, folder: str, made: dict[str, Callable[[DataFrame], DataFrame]]) -> None:
    """One micro-batch to all outputs; the same batch again replaces it."""
    spark = messages.sparkSession
    kept = f"{folder}/input/batch={batch_id}"
    messages.write.mode("overwrite").parquet(kept)
    once = dealt(spark.read.schema(messages.schema).parquet(kept))  # a batch's files may be few and large
    for name, make in made.items():
        make(once).write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")


def run_fanout(spark: SparkSession, source_dir: str, schema: str, key: str, text_col: str, sink_name: str, lexicon=None,
               max_files_per_trigger: int = 10_000) -> str:
    """Take every new file of ``source_dir`` (Parquet) and stop; the outputs' folder. Run again under the same name, it takes what has
    come since."""
    folder = shared_path(spark, f"streams/{sink_name}")
    made = outputs(key, text_col, lexicon)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)
    q = (source.writeStream.foreachBatch(lambda batch, i: write_batch(batch, i, folder, made))
         .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return folder


def read_output(spark: SparkSession, folder: str, name: str, like: DataFrame) -> DataFrame:
    """An output over all batches; ``like`` gives its columns."""
    return spark.read.schema(like.schema).parquet(f"{folder}/{name}").select(*like.columns)
