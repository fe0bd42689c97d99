"""Q8 as a fail-fast check of a dataset's files: it stops at the first bad row in the order of (file, line).

Files are read in waves of growing size in the order of their names; a wave's rows go through the gate, and counts by domain and
source and the least (file, line) with a violation come back. The first wave with a violation ends the check, so a dataset that
is bad early costs its first files only, and a clean one is read once, most of it in a few large waves. Rows never leave the tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.lines import read_jsonl_lines

RESULT = "status string, message string, file string, line bigint, rows bigint, domains map<string,bigint>, sources map<string,bigint>, files_read bigint, files bigint"


def first_failure(spark: SparkSession, path: str, schema: str, gate: Callable[[DataFrame], DataFrame],
                  expected: Callable[[int], dict[str, int] | None] | None = None, first_files: int = 1, growth: int = 4,
                  split_bytes: int | None = None, deal: bool = False) -> DataFrame:
    """One row: PASS with the counts, or FAIL with the message of the first bad row.

    ``gate`` adds ``first_violation`` (null for a good row), ``domain`` and ``source`` to the records; ``expected`` gives the domain
    counts that a set of so many rows must have, if any. Lines that aren't records of the schema fail like rows that break a rule.
    ``deal``: lines go to all tasks before they are parsed and pass the gate; for compressed files, each of which one task reads."""
    files = sorted(spark.read.text(path).inputFiles())
    rows, domains, sources, read = 0, Counter(), Counter(), 0

    def result(status, message, file=None, line=None):
        return spark.createDataFrame([(status, message, file, line, rows, dict(domains), dict(sources), read, len(files))], RESULT)

    size = first_files
    while read < len(files):
        wave = files[read:read + size]
        records = read_jsonl_lines(spark, wave, schema, split_bytes, strict=False, deal=deal)
        checked = gate(records).withColumn("_bad", F.when(F.col("malformed"), "not a JSON record of the schema").otherwise(F.col("first_violation")))
        each = checked.groupBy("domain", "source").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(
            F.col("_bad").isNotNull(), F.struct("file", "line", F.col("_bad").alias("message")))).alias("first")).collect()  # a row a domain and source
        read, size = read + len(wave), size * growth
        failed = [r.first for r in each if r.first is not None]
        for r in each:
            rows += r.n
            domains[r.domain or "None"] += r.n
            sources[r.source or "None"] += r.n
        if failed:
            file, line, message = min(failed)
            return result("FAIL", f"FAIL {file}:{line}: {message}", file, line)
    if not rows:
        return result("FAIL", f"FAIL {path}: empty dataset")
    wanted = expected(rows) if expected else None
    if wanted and dict(domains) != wanted:
        return result("FAIL", f"FAIL {path}: domain counts mismatch. got={dict(sorted(domains.items()))} expected={dict(sorted(wanted.items()))}")
    return result("PASS", None)
