"""Redaction of a log stream before storage (Structured Streaming).

Stateless: ``readStream`` -> PII redaction Column -> ``writeStream`` (append).
No watermark or state store is needed. The checkpoint lives under the shared
``spark.checkpoint.dir``, so a restarted query resumes after executor or driver
loss without re-emitting committed files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..session import shared_path


def redact_stream(stream: DataFrame, text_col: str, out_col: str = "redacted_text") -> DataFrame:
    """The stateless transformation, usable on a batch or a streaming DataFrame."""
    return stream.withColumn(out_col, TX.redact_pii(F.col(text_col))).drop(text_col)


def run_file_stream(spark: SparkSession, source_dir: str, schema: str, text_col: str, sink_name: str,
                    fmt: str = "parquet", max_bytes_per_trigger: int = 64 << 30) -> str:
    """Redact every file of ``source_dir`` (a file or a table's folder, as a stream) into a parquet sink; returns its path.

    Uses the ``availableNow`` trigger: everything present is processed in micro-batches of up to
    ``max_bytes_per_trigger`` (all files of one run in parallel), then the query stops. ``sink_name`` is the query's
    identity: run again with the same name it resumes from its checkpoint and takes new files only."""
    sink = shared_path(spark, f"streams/{sink_name}/data")
    ckpt = shared_path(spark, f"streams/{sink_name}/checkpoint")
    source = source_dir.rstrip("/")
    source = f"{source[:-1]}[{source[-1]}]"  # a pattern that matches this path only: then a single file will do, too
    src = (spark.readStream.format(fmt).schema(schema)
                .option("maxBytesPerTrigger", str(max_bytes_per_trigger)).load(source))
    q = (redact_stream(src, text_col).writeStream.format("parquet")
             .option("path", sink).option("checkpointLocation", ckpt)
             .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return sink
