"""Driver tables (parquet) with explicit column selection.

Reading through ``spark.read.parquet`` keeps predicate pushdown and column
pruning: a job that uses two columns only ever reads those two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores: a table of fewer splits than cores (one small file) is dealt out before costly row work.
    Select the columns needed first. Tables of more splits, as any large one, are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Rows that a task of row work over short rows (keys) takes.
TASK_ROWS = 50_000


def dealt(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df``, keys or other short rows, in even parts of at most about ``task_rows`` rows, and over all cores. However a file's row groups are cut, and
    however many rows there are, no task of the work that follows takes more. The rows are counted by the files' footers."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // task_rows)))
