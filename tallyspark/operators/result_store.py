"""X4 across runs: a stored table of key -> result; what it holds is never computed again.

A batch of new results is written to a folder of its own and counts from the moment its commit record is there, a file that
Spark's writer puts in place at once. A job that dies leaves a batch that nobody reads. Two runs that compute a key at the same time
leave it twice; readers take one of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .split import content_key

#: New keys up to which the rows that hold them are found by a broadcast (a key is about 80 bytes); beyond it rows are shuffled.
BROADCAST_KEYS = 200_000


class ResultStore:
    """Results of type ``kind`` under ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, kind: str):
        self.spark, self.path, self.kind = spark, path.rstrip("/"), kind
        spark.createDataFrame([], "value string").write.mode("ignore").text(f"{self.path}/commits")  # a new store

    def batches(self) -> list[str]:
        """Names of the committed batches: one a call that found something new."""
        return sorted(r.value for r in self.spark.read.text(f"{self.path}/commits").collect())

    def results(self) -> DataFrame:
        """(cache_key, result, batch): one row a key."""
        schema = f"cache_key string, result {self.kind}"
        names = self.batches()
        if not names:
            return self.spark.createDataFrame([], f"{schema}, batch string")
        parts = [self.spark.read.schema(schema).parquet(f"{self.path}/batches/{n}").withColumn("batch", F.lit(n)) for n in names]
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        if len(parts) == 1:
            return found
        first = found.groupBy("cache_key").agg(F.min(F.struct("batch", "result")).alias("one"))
        return first.select("cache_key", "one.result", "one.batch")

    def add(self, rows: DataFrame) -> int:
        """Append (cache_key, result) rows as one batch; how many there were."""
        name = f"{len(self.batches()):06d}-{uuid.uuid4().hex}"
        seen = F.count(F.lit(1)).alias("n")
        observed = Observation()
        rows.select("cache_key", "result").observe(observed, seen).write.parquet(f"{self.path}/batches/{name}")
        self.spark.createDataFrame([(name,)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/commits")
        return observed.get["n"]

    def get_or_compute(self, df: DataFrame, prefix: str, payload_col: str, fn: Callable[[Column], Column], out_col: str
                       ) -> tuple[DataFrame, int]:
        """``df`` with ``cache_key`` and ``out_col``, and the number of keys that had to be computed. Each distinct payload that the store
        lacks is computed once, from one of its rows; a null payload has a null key and a null result."""
        keyed = df.withColumn("cache_key", content_key(prefix, payload_col))
        missing = keyed.select("cache_key").filter("cache_key IS NOT NULL").distinct().join(
            self.results().select("cache_key"), "cache_key", "left_anti")
        path = f"{self.path}/missing/{uuid.uuid4().hex}"
        missing.write.parquet(path)
        missing = self.spark.read.schema("cache_key string").parquet(path)
        new = missing.count()
        if new:
            wanted = F.broadcast(missing) if new <= BROADCAST_KEYS else missing
            once = (keyed.select("cache_key", payload_col).join(wanted, "cache_key", "left_semi")
                    .groupBy("cache_key").agg(F.any_value(payload_col).alias("_payload")))
            self.add(once.select("cache_key", fn(F.col("_payload")).cast(self.kind).alias("result")))
        return keyed.join(self.results().select("cache_key", F.col("result").alias(out_col)), "cache_key", "left"), new
