"""Splits and content-hash memoisation.

Exact-size cuts ("the first k rows by a key") never sort the whole table into one task and never collect keys:
``first_rows`` narrows the k-th smallest key down by histograms over 16 bits of the key at a time (distributed
aggregates of at most 65,536 counts each). The split is then a predicate; rows that tie on the key at the cut are told
apart by a second key, and rows that tie on both, which are interchangeable, by a rank among themselves spread over
their partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

PREFIX_STEP = 4          # hex characters per refinement pass (<= 65,536 groups)


def id_hex(col) -> Column:
    """Zero-padded 16-digit hex of a non-negative bigint (sorts like the number)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lpad(F.lower(F.hex(c)), 16, "0")


def kth_key(df: DataFrame, key_col: str, k: int):
    """(k-th smallest value of a string key, how many of its rows are among the first k); (None, 0) if there aren't
    k rows. Null keys come last and are never chosen. Repeated keys count as often as they occur."""
    if k < 1:
        return None, 0
    keys = df.select(F.col(key_col).alias("k")).filter(F.col("k").isNotNull())
    length = keys.agg(F.max(F.length("k"))).first()[0] or 0
    prefix, remaining = "", k
    while len(prefix) < length:
        hist = (keys.filter(F.startswith(F.col("k"), F.lit(prefix)))
                    .groupBy(F.substring("k", len(prefix) + 1, PREFIX_STEP).alias("p"))
                    .agg(F.count(F.lit(1)).alias("n")).collect())  # at most 16 ** PREFIX_STEP counts
        for r in sorted(hist, key=lambda r: r["p"]):
            if r["n"] >= remaining:
                break
            remaining -= r["n"]
        else:
            return None, 0
        prefix += r["p"]
        if len(r["p"]) < PREFIX_STEP or r["n"] == 1:  # the key ends here, or only one is left
            break
    found = keys.filter(F.startswith(F.col("k"), F.lit(prefix))).agg(F.min("k")).first()[0]
    return found, remaining


def first_rows(df: DataFrame, key: Column, k: int) -> Column | DataFrame:
    """``df`` with ``_first``: true for exactly k rows with the smallest ``key`` (hex string; nulls last).

    Rows with the cut's key are ranked by partition: counts by partition (a small table) give each
    partition its share, and a window inside it the rows. With unique keys that is one row."""
    keyed = df.withColumn("_key", key)
    cut, share = kth_key(keyed, "_key", k)
    if cut is None:
        n = keyed.count() if k > 0 else 0
        nulls = keyed.filter(F.col("_key").isNull()).count() if k > 0 else 0
        if k < 1 or not nulls or k > n:
            return keyed.withColumn("_first", F.lit(k > 0)).drop("_key")
        cut, share, tie = "", k - (n - nulls), F.col("_key").isNull()
        below = F.col("_key").isNotNull()
    else:
        tie, below = F.col("_key").eqNullSafe(F.lit(cut)), F.coalesce(F.col("_key") < F.lit(cut), F.lit(False))
    ties = keyed.filter(tie).count()
    if ties <= share:
        return keyed.withColumn("_first", below | tie).drop("_key")
    placed = keyed.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    counts = placed.filter(tie).groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_part", before.alias("_before"))  # one row a partition
    rank = F.row_number().over(Window.partitionBy("_part").orderBy("_at"))
    tied = placed.filter(tie).withColumn("_rank", rank).join(counts, "_part")
    tied = tied.withColumn("_first", F.col("_before") + F.col("_rank") <= share).drop("_part", "_at", "_before", "_rank", "_key")
    return keyed.filter(~tie).withColumn("_first", below).drop("_key").unionByName(tied)


def seeded_split(df: DataFrame, id_col: str, seed: int = 42, val_ratio: float = 0.1) -> DataFrame:
    """Deterministic shuffle by md5(seed:id); val = max(1, int(n*ratio)) when n > 1, else 0;
    train = the rest, or everything when the rest is empty. Adds ``split`` ('train'/'val'/'both').

    Sizes are exact with repeated ids too (equal ids fall next to each other in the shuffle); null ids come last."""
    text = F.col(id_col).cast("string")
    key = F.concat(F.md5(F.concat(F.lit(f"{seed}:"), text)), id_hex(id_col))
    n = df.count()
    val_count = max(1, int(n * val_ratio)) if n > 1 else 0
    marked = first_rows(df, key, val_count)
    label = F.lit("both" if val_count >= n and n > 0 else "val")
    return marked.withColumn("split", F.when(F.col("_first"), label).otherwise(F.lit("train"))).drop("_first")


def prefix_split(df: DataFrame, order_col: str, ratio: float = 0.9) -> DataFrame:
    """The first int(ratio*n) rows by ``order_col`` (non-negative bigint) are train; exact with repeated and null
    (last) values. Leading digits that every value has as zero are left out of the key, which saves passes."""
    n, top = df.agg(F.count(F.lit(1)), F.max(order_col)).first()
    width = max(PREFIX_STEP, -(-len(f"{top or 0:x}") // PREFIX_STEP) * PREFIX_STEP)
    marked = first_rows(df, F.right(id_hex(order_col), F.lit(width)), int(n * ratio))
    return marked.withColumn("split", F.when(F.col("_first"), "train").otherwise("val")).drop("_first")


def stratified_prefix_split(df: DataFrame, group_col: str, order_col: str, ratio: float = 0.9,
                            bucket_size: int = 1_000_000) -> DataFrame:
    """Per group, the first floor(ratio*count) rows by ``order_col`` are train.

    Rank inside a group = rows of the group in earlier buckets (prefix sums over a
    small (group, bucket) count table) + rank inside the bucket. Buckets hold at
    most ``bucket_size`` consecutive order values, so no window ever sees a whole
    group, however large or skewed the group is.
    """
    o = F.col(order_col)
    b = F.floor(o / F.lit(bucket_size)).cast("bigint")
    with_b = df.withColumn("_bucket", b)
    counts = with_b.groupBy(group_col, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(group_col).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
                     .withColumn("_group_n", F.sum("_n").over(Window.partitionBy(group_col)))
                     .drop("_n"))
    ranked = (with_b.withColumn("_in_bucket", F.row_number().over(
        Window.partitionBy(group_col, "_bucket").orderBy(o))))
    # offsets has one row per (group, bucket): it grows with the data, so no broadcast
    # hint; AQE broadcasts it at run time when it is small
    joined = ranked.join(offsets, [group_col, "_bucket"], "left")
    rank = F.col("_before") + F.col("_in_bucket")
    cut = F.floor(F.col("_group_n") * F.lit(ratio))
    return (joined.withColumn("group_rank", rank)
                  .withColumn("split", F.when(rank <= cut, "train").otherwise("val"))
                  .drop("_bucket", "_before", "_group_n", "_in_bucket"))


def content_key(prefix: str, payload) -> Column:
    """``prefix:sha256(payload)``."""
    c = F.col(payload) if isinstance(payload, str) else payload
    return F.concat(F.lit(prefix + ":"), F.sha2(c, 256))


def compute_once(df: DataFrame, key: Column, payload_col: str, fn, out_col: str) -> DataFrame:
    """Evaluate ``fn(payload)`` once per distinct key and join the result back.

    The payload goes into the distinct side only (one row per key and task after the map-side combine); the rows
    that meet the results again carry it no more, unless they are columns the caller kept in ``df``."""
    keyed = df.withColumn("_ckey", key)
    computed = (keyed.groupBy("_ckey").agg(F.any_value(payload_col).alias("_payload"))
                     .select("_ckey", fn(F.col("_payload")).alias(out_col)))
    return keyed.drop(payload_col).join(computed, "_ckey", "left").withColumnRenamed("_ckey", "cache_key")
