from collections import Counter

from pyspark.sql import functions as F

from tallyspark.llm import mixing
from test_pipeline import poisson_count


def test_counts_follow_targets(spark):
    rows = [(i, "ab" * (1 + i % 3), "big" if i % 3 else "small") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_sources(spark, df, weights={"big": 1, "small": 3}).cache()
    size = {r.source: r.s for r in out.groupBy("source").agg(F.sum(F.length("text")).alias("s")).collect()}
    assert abs(size["small"] / (size["small"] + size["big"]) - 0.75) < 0.03
    whole = sum(len(t) for _, t, _ in rows)
    assert abs(size["small"] + size["big"] - whole) < 0.05 * whole
    rate = {r.source: r.rate for r in out.select("source", "rate").distinct().collect()}
    got = Counter(r.doc_id for r in out.collect())
    for i, _, s in rows[:400]:
        u = mixing.uniform(mixing.SEED, F.lit(str(i)))
        u = spark.range(1).select(u).first()[0] if i < 3 else None
        if u is not None:
            assert got[i] == poisson_count(u, rate[s])
    positions = [r.doc_id for r in out.limit(2000).collect()]
    assert positions != sorted(positions)


def test_odd_rows(spark):
    rows = [(1, "a", None), (2, None, "none"), (None, "x", "s"), (None, "y", "s"), (3, "", "empty"), (4, "z" * 10**6, "s"),
            (4, "z" * 10**6, "s")]
    df = spark.createDataFrame([(*r, 7, "c") for r in rows], "doc_id long, text string, source string, rate int, copy string")
    out = mixing.mix_sources(spark, df, epochs=3.0)
    assert out.columns == [*df.columns, "_rate", "n_copies", "_copy", "shuffle_key"]
    got = out.collect()
    assert {r["rate"] for r in got} <= {7} and all(1 <= r["_copy"] <= r["n_copies"] for r in got)
    twice = Counter(r.n_copies for r in got if r.doc_id == 4 and r["_copy"] == 1)
    assert not twice or list(twice.values()) == [2]
    assert mixing.mix_sources(spark, df.limit(0)).count() == 0
    assert mixing.mix_sources(spark, df, weights={}).count() >= 0


def test_large_means_do_not_underflow(spark):
    rates = spark.createDataFrame([("a", 2000.0), ("b", 0.0), ("c", 0.4)], "src string, rate double")
    tables = {r.src: r.cdf for r in mixing.poisson_tables(rates).collect()}
    assert abs(tables["a"][-1] - 1) < 1e-9 and 0.4 < tables["a"][2000] < 0.6
    assert tables["b"][0] == 1.0 and abs(tables["c"][0] - 0.670320046) < 1e-9
