"""Equality of record sets, with repeated records counted: which are missing, which are surplus, and how many of each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """The columns of ``expected``, ``side`` ('missing' from ``actual`` or 'surplus' in it) and ``n``: by how many copies of the record
    the sets differ. Equal sets give no row. Columns are matched by name; nulls equal nulls.

    Both sides are counted by record before they meet, so a record repeated often costs one row a task."""
    if sorted(expected.columns) != sorted(actual.columns):
        raise ValueError("the sets have different columns")
    names = expected.columns
    n = "_n"
    while n in names:
        n = "_" + n
    each = expected.withColumn(n, F.lit(1)).unionByName(actual.withColumn(n, F.lit(-1)))
    off = each.groupBy(*names).agg(F.sum(n).alias(n)).filter(F.col(n) != 0)
    return off.select(*names, F.when(F.col(n) > 0, "missing").otherwise("surplus").alias("side"), F.abs(n).alias("n"))


def equality(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """One row a pair (expected, actual): ``missing`` and ``surplus`` records by ``exceptAll`` both ways, and whether they are equal."""
    rows = []
    for name, (expected, actual) in pairs.items():
        actual = actual.select(*expected.columns)
        sides = (expected.exceptAll(actual).select(F.lit("missing").alias("side"))
                 .unionAll(actual.exceptAll(expected).select(F.lit("surplus").alias("side"))))
        rows.append(sides.agg(F.count_if(F.col("side") == "missing").alias("missing"), F.count_if(F.col("side") == "surplus").alias("surplus"))
                    .select(F.lit(name).alias("name"), "missing", "surplus", ((F.col("missing") == 0) & (F.col("surplus") == 0)).alias("equal")))
    return reduce(DataFrame.unionAll, rows)
