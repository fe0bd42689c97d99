"""Beyond the broadcast limit joins are shuffled; results are the same, under a hot key too."""

from pyspark.sql import functions as F

from tallyspark.llm import common, exact_dedup, language_id, mixing, simhash


def same(spark, monkeypatch, make):
    rows = lambda: sorted(map(str, make().collect()))
    small = rows()
    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = make()._jdf.queryExecution().executedPlan().toString()
        assert rows() == small and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def hot_docs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    hot = spark.range(120).select((F.col("id") + 5000).alias("doc_id"), F.concat(F.lit("the same hot text of and the "), (F.col("id") % 3)).alias("text"),
                                  F.lit("en").alias("lang"), F.lit("src0").alias("source"), F.lit(10).cast("long").alias("n_chars"))
    return docs.unionByName(hot)


def test_near_copies(spark, monkeypatch):
    same(spark, monkeypatch, lambda: simhash.drop_near_copies(spark, hot_docs(spark)))


def test_mixing(spark, monkeypatch):
    same(spark, monkeypatch, lambda: mixing.mix_sources(spark, hot_docs(spark)))


def test_language(spark, monkeypatch):
    same(spark, monkeypatch, lambda: language_id.accepted_rows(spark, hot_docs(spark)))


def test_hot_groups_meet_their_result_over_salts(spark):
    got = exact_dedup.exact_dedup(spark, hot_docs(spark))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "salt" in plan and got.where("group_size = 40").count() == 120 and got.where("group_size = 40 AND kept").count() == 3
