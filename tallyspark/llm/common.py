"""Small helpers shared by the operators: shared-folder tables, size-checked joins, free column names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

#: A side with at most this many values (rows, or entries of their arrays) may be broadcast; beyond it the join is shuffled.
BROADCAST_ROWS = 200_000
#: Copies made of the grouped side so that the rows of one hot key spread over several tasks.
SALTS = 8


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder (``spark.checkpoint.dir``)."""
    return shared_path(spark, f"{label}-{uuid.uuid4().hex}")


def materialise(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch: two workers and the heap share an executor's memory.
ARROW_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to ``ARROW_BYTES`` where they may be larger."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = "".join(c for c in spark.conf.get(name) if c.isdigit())
    if not 0 < int(size or 0) <= ARROW_BYTES:
        spark.conf.set(name, f"{ARROW_BYTES}b")


def free_name(df: DataFrame, base: str) -> str:
    """``base`` with as many underscores in front as it takes not to clash with a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def join_small(left: DataFrame, right: DataFrame, on, how: str = "left", limit: int | None = None,
               entries: Column | None = None) -> DataFrame:
    """Join with a *materialised* narrow ``right``: broadcast if its rows (and the sum of ``entries``, the length of their
    arrays) are counted to be at most ``limit`` (``BROADCAST_ROWS`` unless given), else a shuffled join whose hot keys AQE can split (both sides come
    from plain exchanges)."""
    rows, values = right.agg(F.count("*"), F.sum(F.lit(0) if entries is None else entries)).first()
    side = F.broadcast(right) if max(rows, values or 0) <= (BROADCAST_ROWS if limit is None else limit) else right.hint("shuffle_merge")
    return left.join(side, on, how)


def salted(df: DataFrame, name: str, *by: Column, salts: int = SALTS) -> DataFrame:
    """Add the salt of each row, from a hash of ``by``."""
    return df.withColumn(name, F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))


def all_salts(df: DataFrame, name: str, salts: int = SALTS) -> DataFrame:
    """One copy of each row for each salt: the grouped side of a salted join."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
