"""Hot keys: one conversation / one group holding a third or more of all rows.

The reports must give the same answers as their plain definitions, and their
plans must not gather a whole group into one array.
"""

from pyspark.sql import functions as F

from tallyspark.operators import conversation as CV
from tallyspark.operators import split as SP


def _turns(spark):
    # conversation 0 holds 3,000 of 9,000 turns; 1,500 small conversations hold the rest
    hot = [(0, t, "user" if t % 2 == 0 else "assistant", f"hot {t}") for t in range(3000)]
    small = [(c, t, "user" if t % 2 == 0 else "assistant", f"c{c} t{t}") for c in range(1, 1501) for t in range(4)]
    return spark.createDataFrame(hot + small, "conv_id long, turn long, role string, text string"), hot + small


def test_conversation_reports_under_a_hot_conversation(spark):
    df, rows = _turns(spark)
    summary = {r.conv_id: r for r in CV.conversation_summary(df).collect()}
    assert summary[0].n_messages == 3000 and summary[0].first_role == "user" and summary[0].last_role == "assistant"
    acc = {r.conv_id: r for r in CV.message_accessors(df).collect()}
    assert acc[0].second_content == "hot 1" and acc[0].last_content == "hot 2999"
    assert acc[7].second_content == "c7 t1" and acc[7].assistant_v2 == "c7 t3"
    latest = {r.conv_id: r.latest_user for r in CV.latest_user_turn(df).collect()}
    assert latest[0] == "hot 2998"
    errors = {r.conv_id: r.error for r in CV.message_validation(df).collect()}
    assert all(e is None for e in errors.values()) and len(errors) == 1501
    for report in (CV.conversation_summary(df), CV.message_accessors(df), CV.message_validation(df)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "collect_list" not in plan


def test_stratified_split_with_a_dominant_group(spark):
    n = 30_000
    df = spark.range(n).withColumn("g", F.when(F.col("id") % 10 < 8, F.lit("big"))
                                          .otherwise((F.col("id") % 10).cast("string")))
    out = SP.stratified_prefix_split(df, "g", "id", 0.9, bucket_size=1000)
    got = {(r.g, r.split): r["count"] for r in out.groupBy("g", "split").count().collect()}
    sizes = {"big": 24_000, "8": 3_000, "9": 3_000}
    for g, size in sizes.items():
        assert got[(g, "train")] == int(size * 0.9) and got[(g, "val")] == size - int(size * 0.9)
    # ranks are the exact in-group positions
    ranks = out.filter(F.col("g") == "big").select("id", "group_rank").orderBy("id").limit(5).collect()
    assert [r.group_rank for r in ranks] == [1, 2, 3, 4, 5]
    last_train = out.filter((F.col("g") == "big") & (F.col("split") == "train")).agg(F.max("group_rank")).first()[0]
    assert last_train == int(24_000 * 0.9)


def test_kth_key_multi_pass(spark):
    n = 100_017  # more keys than one histogram tells apart
    keyed = spark.range(n).withColumn("k", F.concat(F.md5(F.col("id").cast("string")), SP.id_hex("id")))
    k = n // 3
    expect = keyed.orderBy("k").select("k").limit(k).collect()[-1]["k"]
    assert SP.kth_key(keyed, "k", k) == (expect, 1)


def test_cuts_are_exact_with_repeated_and_null_keys(spark):
    same = spark.createDataFrame([(7,)] * 10, "id long")
    mixed = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,), (3,), (2**40,), (0,), (1,)], "id long").repartition(3)
    for df in (same, mixed):
        for ratio in (0.1, 0.5, 0.9):
            count = lambda split: {r.split: r["count"] for r in split.groupBy("split").count().collect()}
            assert count(SP.prefix_split(df, "id", ratio)).get("train", 0) == int(10 * ratio)
            assert count(SP.seeded_split(df, "id", val_ratio=ratio))["val"] == int(10 * ratio)
    train = SP.prefix_split(mixed, "id", 0.7).filter("split = 'train'").collect()
    assert sorted(r.id for r in train) == [0, 1, 1, 1, 1, 2, 3]
    assert SP.prefix_split(mixed, "id", 0.9).filter("split = 'train' AND id IS NULL").count() == 1
    assert SP.prefix_split(mixed.limit(0), "id").count() == 0 and SP.seeded_split(mixed.limit(0), "id").count() == 0


def test_message_accessors_limit_rows_before_the_shuffle(spark):
    df, _ = _turns(spark)
    plan = CV.message_accessors(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "collect" not in plan


def test_compute_once_under_a_hot_payload(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(9000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('p', id) END AS payload")
        out = SP.compute_once(df, SP.content_key("p", F.col("payload")), "payload", F.length, "size")
        assert out.count() == 9000 and out.filter("size = 3").count() >= 3000
        assert "payload" not in out.columns
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
