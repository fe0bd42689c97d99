"""Findings of round 4: what the queries leave on the disk, and how many tasks work on it."""

import glob

import tallyspark.plans.registry  # noqa: F401 - first, as the entry has it
from pyspark.sql import functions as F

from tallyspark.functions import text as TX
from tallyspark.operators import fail_fast as FF
from tallyspark.plans import files
from tallyspark.session import ensure_checkpoint_dir


def orders(spark, tmp_path, n):
    spark.range(n).withColumnRenamed("id", "o_orderkey").write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_partitioned_sets_are_compressed(spark, tmp_path):
    base = f"{ensure_checkpoint_dir(spark)}/partitioned"
    before = set(glob.glob(f"{base}/*"))
    rows = files.jsonl_partitioned(spark, orders(spark, tmp_path, 2_000)).collect()
    assert len({r.gidx for r in rows}) == len(rows) > 1_000 and {r.split for r in rows} == {"train", "val"}
    made, = set(glob.glob(f"{base}/*")) - before
    written = glob.glob(f"{made}/split=*/domain=*/*")
    assert len(written) > 10 and all(f.endswith(".json.gz") for f in written)


def test_blank_is_what_strip_leaves_empty(spark):
    texts = [None, "", " ", "\n", " \t\r\n\x0b\x0c", "\x1c\x1f\x85\xa0\u2003\u3000", "\u200b", "a", " a ", "\n\n.", "\U0001f600", " \U0001f600 ", "\u2028\u2029 ", "\ufeff", "\x00"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = rows.select("i", TX.is_blank("t").alias("b"), F.coalesce(F.length(TX.py_strip("t")) == 0, F.lit(True)).alias("want")).collect()
    assert all(r.b == r.want for r in got) and {r.i for r in got if r.b} == {i for i, t in enumerate(texts) if not (t or "").strip()}


def test_blank_lines_are_told_without_a_pass_over_the_text(spark):
    """A search for the end of a text tries every run of blanks in it: that took most of a long line's reading."""
    assert "regexp_replace" not in str(spark.range(1).select(TX.is_blank(F.lit("x")))._jdf.queryExecution().logical())


def test_lines_of_one_compressed_file_are_parsed_by_many_tasks(spark, tmp_path):
    spark.range(3_000).selectExpr("to_json(struct(id)) AS value").coalesce(1).write.option("compression", "gzip").text(str(tmp_path / "in"))
    seen = []

    def gate(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        seen.append(plan.index("from_json") < plan.index("Repartition"))  # an operator stands above its input
        return df.withColumns({"first_violation": F.when(F.col("id") == 2_999, "last"), "domain": F.lit("d"), "source": F.lit("s")})

    row = FF.first_failure(spark, str(tmp_path / "in"), "id long", gate, deal=True).first()
    assert seen == [True] and (row.status, row.line, row.rows) == ("FAIL", 3_000, 3_000)
