"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the mixture; its mean repetition rate is share x wanted size / own size. The copy
count of a document is the quantile of a Poisson distribution with that mean at a point in (0, 1) that a seeded hash of
its id gives: the same document gets the same count in every run, and a source's size comes out as its target up to
sampling noise. Documents are repeated by their counts and shuffled globally by a hash of id and copy number.

Sizes and rates are grouped aggregates combined before the shuffle, so a hot source costs nothing extra; the table of
sources is broadcast only behind a count. All of it is DataFrame functions.

Defined results. Null source: a source of its own. Null or empty text: size 0 (a source without any size has rate 1).
Null id: the hash of the text takes its place. Rows that repeat an id get equal counts. Empty table: empty result.
Other columns are passed on; those added take names that are free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_name, join_small, materialise

#: Without given weights the target share of a source is in proportion to its size to this power.
TEMPERATURE = 0.7
#: Size of the mixture, as a multiple of the input's.
EPOCHS = 1.0
SEED = 17


def _key(id_col: str, text_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))


def uniform(seed: int, key: Column) -> Column:
    """A point in (0, 1) from the first 52 bits of a seeded MD5."""
    head = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13)
    return (F.conv(head, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_rates(spark: SparkSession, docs: DataFrame, source_col: str, text_col: str, weights: dict | None, temperature: float,
                 epochs: float) -> DataFrame:
    """(src, rate): the mean number of copies of a source's documents. ``weights`` gives target shares by source (they
    are scaled to sum 1; a source without a weight gets none)."""
    sizes = materialise(spark, docs.groupBy(F.col(source_col).alias("src"))
                        .agg(F.sum(F.length(F.coalesce(F.col(text_col), F.lit("")))).alias("size")), "mixing-sizes")
    if not weights:
        weighed = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        weighed = sizes.withColumn("weight", F.coalesce(table[F.col("src")].cast("double"), F.lit(0.0)))
    size, weight = weighed.agg(F.sum("size"), F.sum("weight")).first()
    rate = F.col("weight") / F.lit(weight or 1.0) * F.lit(epochs) * F.lit(float(size or 0)) / F.col("size")
    sized = (F.col("size") > 0) & F.lit(bool(weight))
    return weighed.select("src", F.when(sized, rate).otherwise(F.lit(1.0)).alias("rate"))


def poisson_tables(rates: DataFrame) -> DataFrame:
    """Add ``cdf``: the Poisson distribution function of ``rate`` at 0, 1, ... up to 12 deviations above the mean. Its
    terms are summed in logarithms, so that large means don't underflow."""
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    upto = Window.partitionBy("src").orderBy("k")
    steps = (rates.withColumn("k", F.explode(F.sequence(F.lit(0), last)))
             .withColumn("log_factorial", F.sum(F.log(F.greatest(F.col("k"), F.lit(1)).cast("double"))).over(upto))
             .withColumn("p", F.when(F.col("rate") > 0, F.exp(-F.col("rate") + F.col("k") * F.log("rate") - F.col("log_factorial")))
                         .otherwise((F.col("k") == 0).cast("double")))
             .withColumn("c", F.sum("p").over(upto)))
    return (steps.groupBy("src", "rate").agg(F.sort_array(F.collect_list(F.struct("k", "c"))).alias("steps"))
            .select("src", "rate", F.col("steps.c").alias("cdf")))


def mix_sources(spark: SparkSession, docs: DataFrame, weights: dict | None = None, temperature: float = TEMPERATURE,
                epochs: float = EPOCHS, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """The mixture in random order: the columns of ``docs`` and, under free names, rate, n_copies, copy (from 1) and
    shuffle_key."""
    src, rate, cdf, n, copy, order = (free_name(docs, x) for x in ("src", "rate", "cdf", "n_copies", "copy", "shuffle_key"))
    table = materialise(spark, poisson_tables(source_rates(spark, docs, source_col, text_col, weights, temperature, epochs)),
                        "mixing-rates").toDF(src, rate, cdf)
    point = uniform(seed, _key(id_col, text_col))
    counted = (join_small(docs, table, F.col(source_col).eqNullSafe(F.col(src)), "inner", entries=F.size(F.col(cdf)))
               .withColumn(n, F.size(F.filter(F.col(cdf), lambda c: c < point))).where(F.col(n) > 0))
    copies = counted.drop(src, cdf).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n))))
    key = F.md5(F.concat_ws(":", F.lit(f"shuffle {seed}"), _key(id_col, text_col), F.col(copy)))
    return copies.withColumn(order, key).repartition(F.col(order)).sortWithinPartitions(order)
