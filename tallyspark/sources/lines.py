"""S3: JSON-lines scans that know each record's file and physical line.

A large file is read in splits by many tasks, none of which knows how many lines lie before its split. Lines are counted by split
first (a scan of positions, one small row a split), prefix sums over a file's splits give each split its first line, and a
second scan adds the place inside the split. Blank lines count, as they do for a reader that goes through the file; a line ends at LF, CR LF or
CR. The same splits must come up in both scans: a split that the first one didn't count makes an error, never a wrong number.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..session import shared_path

#: Splits (rows of about 100 bytes) up to which their first lines are broadcast; beyond that the join is Spark's choice.
BROADCAST_SPLITS = 1_000_000


def _with_splits(spark: SparkSession, split_bytes: int | None) -> SparkSession:
    """A session with the same settings and splits of ``split_bytes``."""
    if split_bytes is None:
        return spark
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", str(min(split_bytes, 4 << 20)))
    return own


def split_size(spark: SparkSession, path: str, least: int, splits_a_core: int = 32) -> int:
    """Bytes of a split for all files of ``path``: some splits a core however large the files are, and ``least`` for small ones."""
    total = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0  # sizes only, no content is read
    return max(least, total // (splits_a_core * spark.sparkContext.defaultParallelism))


def numbered_lines(spark: SparkSession, path: str | list[str], split_bytes: int | None = None) -> DataFrame:
    """(file, line, value): every physical line, blank ones too, numbered from 1 in its file."""
    meta = F.col("_metadata")
    scan = _with_splits(spark, split_bytes).read.text(path).select(
        "value", meta["file_path"].alias("file"), meta["file_block_start"].alias("_split"), F.monotonically_increasing_id().alias("_at"))
    counted = scan.groupBy("file", "_split").agg(F.count(F.lit(1)).alias("_lines"), F.min("_at").alias("_first"))
    kept = shared_path(spark, f"line-counts/{uuid.uuid4().hex}")
    counted.write.parquet(kept)
    upto = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    firsts = spark.read.schema(counted.schema).parquet(kept)
    splits = firsts.count()
    firsts = firsts.withColumn("_before", F.coalesce(F.sum("_lines").over(upto), F.lit(0)))
    joined = scan.join(F.broadcast(firsts) if splits <= BROADCAST_SPLITS else firsts, ["file", "_split"], "left")
    inside = F.col("_at") - F.col("_first")
    known = F.coalesce((inside >= 0) & (inside < F.col("_lines")), F.lit(False))
    line = F.when(known, F.col("_before") + inside + 1).otherwise(
        F.raise_error(F.concat(F.lit("the splits changed between two scans of "), "file")).cast("bigint"))
    return joined.select("file", line.alias("line"), "value")


def at_line(file: Column, line: Column, message: Column) -> Column:
    """``FAIL file:line: message``."""
    return F.concat(F.lit("FAIL "), file, F.lit(":"), line.cast("string"), F.lit(": "), message)


def read_jsonl_lines(spark: SparkSession, path: str | list[str], schema: str, split_bytes: int | None = None, strict: bool = True,
                     deal: bool = False) -> DataFrame:
    """The records of JSON-lines files with their ``file`` and ``line`` (the columns of ``schema`` follow). Blank lines hold no record. A line that isn't
    a JSON object of the schema is an error that names it; with ``strict=False`` it is a row of nulls with ``malformed`` true.
    ``deal``: lines go to all tasks before they are parsed; for compressed files, each of which one task reads."""
    lines = numbered_lines(spark, path, split_bytes).filter(~is_blank(F.col("value")))
    if deal:
        lines = lines.repartition(F.col("line"))
    parsed = F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    rows = lines.select("file", "line", parsed.alias("_r"))
    bad = F.col("_r").isNull() | F.col("_r._corrupt").isNotNull()
    names = [c for c in spark.createDataFrame([], schema).columns]
    if not strict:
        return rows.select("file", "line", *[F.col(f"_r.{c}").alias(c) for c in names], bad.alias("malformed"))
    message = at_line(F.col("file"), F.col("line"), F.lit("not a JSON record of the schema"))
    # the check is folded into a column that always stays, so it can't be pruned away
    line = F.when(bad, F.raise_error(message).cast("bigint")).otherwise(F.col("line"))
    return rows.select("file", line.alias("line"), *[F.col(f"_r.{c}").alias(c) for c in names])
