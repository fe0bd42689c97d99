"""Exact deduplication by two-pass Bloom filtering, with DataFrame functions only.

Pass 1 sets ``HASHES`` cells per text in a counting filter (an aggregation of cell numbers, combined before the
shuffle) and packs the cells hit at least twice into 4 KB bitmaps. A text that occurs twice hits all of its cells
twice, so pass 2 lets every row with an unset cell straight through: it is unique for sure. Only the other rows, the
possibly repeated ones, are shuffled by their hash and grouped exactly; a wrong guess of the filter costs a shuffle of
that row and never changes a result.

The filter has 16 bits per row, rounded up to a power of two, at least 2^20 and at most ``max_bits``; its broadcast is
at most ``max_bits / 8`` bytes (128 MB). On more rows than that serves, more rows are shuffled; results stay exact.

Hot groups: cells and groups are combined map-side, and the rows of a group meet its result over salted keys.

Defined results. Null text: as empty. Null id: never chosen over a present one. Rows that repeat both id and text
count in ``group_size`` and get one row each; exactly one of them is kept if their id is the one that stays. Empty
table: empty result. Other columns, whatever their names, are ignored (or passed on by :func:`drop_copies`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import all_salts, free_name, materialise, salted

HASHES = 2
MAX_BITS = 1 << 30
_PER_BITMAP = 32768  # bits that bitmap_construct_agg holds


def normalised(text: Column) -> Column:
    """Each run of [\\x20\\x09-\\x0D] as one space. Runs that are one space already aren't matched: it is faster."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x09-\x0D\x20]*|\x20[\x09-\x0D\x20]+", " ")


def text_sha256(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """16 bits a row as a power of two, at least 2^20, at most ``max_bits``."""
    return min(max_bits, max(1 << 20, 1 << (16 * max(rows, 1) - 1).bit_length()))


def _cell(key: str, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(bits))


def repeated_cells(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """Pass 1: (bucket, bitmap) of the cells hit at least twice; at most bits / 32768 rows of 4 KB."""
    cells = (keys.select(F.explode(F.array(*[_cell(key, i, bits) for i in range(HASHES)])).alias("cell"))
             .groupBy("cell").count().where("count >= 2"))
    return (cells.groupBy(F.shiftright("cell", 15).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.col("cell").bitwiseAND(F.lit(_PER_BITMAP - 1))).alias("bitmap")))


def flag_repeated(rows: DataFrame, key: str, bitmaps: DataFrame, bits: int, flag: str) -> DataFrame:
    """Pass 2: add ``flag``, false only if ``key`` occurs once for sure. The bitmaps' size is bounded by ``bits``."""
    hit = F.lit(True)
    for i in range(HASHES):
        bucket, bitmap = f"__bucket{i}", f"__bitmap{i}"
        side = F.broadcast(bitmaps.select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bitmap)))
        rows = rows.join(side, F.shiftright(_cell(key, i, bits), 15) == F.col(bucket), "left")
        at = _cell(key, i, bits).bitwiseAND(F.lit(_PER_BITMAP - 1)).cast("int")
        byte = F.conv(F.hex(F.substring(F.col(bitmap), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.call_function("shiftright", byte, at.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1))
        hit = hit & F.coalesce(bit == 1, F.lit(False))
    drop = [f"__{n}{i}" for i in range(HASHES) for n in ("bucket", "bitmap")]
    return rows.withColumn(flag, hit).drop(*drop)


def _groups(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("sha").agg(F.min("id").alias("keep"), F.sum("n").alias("size"))


def exact_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``id_col``, keep_id, group_size, kept, text_sha256."""
    hashes = materialise(spark, docs.select(F.col(id_col).alias("id"), text_sha256(F.col(text_col)).alias("sha")),
                         "exact-hashes")
    bits = filter_bits(hashes.count(), max_bits)
    flagged = flag_repeated(hashes, "sha", repeated_cells(hashes, "sha", bits), bits, "repeated")
    straight = flagged.where(~F.col("repeated")).select(
        "id", F.col("id").alias("keep"), F.lit(1).cast("long").alias("size"), F.lit(True).alias("kept"), "sha")
    pairs = flagged.where("repeated").groupBy("sha", "id").agg(F.count("*").alias("n"))
    groups = all_salts(_groups(pairs), "salt")
    grouped = (salted(pairs, "salt", F.col("id")).join(groups, ["sha", "salt"])
               .select("id", "keep", "size", "sha", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
               .select("id", "keep", "size", (F.col("id").eqNullSafe(F.col("keep")) & (F.col("copy") == 1)).alias("kept"),
                       "sha"))
    return straight.unionByName(grouped).select(
        F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), "kept",
        F.col("sha").alias("text_sha256"))


def drop_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with all of their columns. Unique rows aren't shuffled."""
    sha, flag, keep, salt = (free_name(docs, n) for n in ("sha", "repeated", "keep", "salt"))
    hashes = materialise(spark, docs.select(F.col(id_col).alias("id"), text_sha256(F.col(text_col)).alias("sha")),
                         "exact-hashes")
    bits = filter_bits(hashes.count(), max_bits)
    bitmaps = materialise(spark, repeated_cells(hashes, "sha", bits), "exact-filter")
    pairs = (flag_repeated(hashes, "sha", bitmaps, bits, "repeated").where("repeated")
             .groupBy("sha", "id").agg(F.count("*").alias("n")))
    groups = _groups(pairs).select(F.col("sha").alias(sha), F.col("keep").alias(keep))
    rows = flag_repeated(docs.withColumn(sha, text_sha256(F.col(text_col))), sha, bitmaps, bits, flag)
    stay = (salted(rows.where(F.col(flag)), salt, F.col(id_col)).join(all_salts(groups, salt), [sha, salt])
            .where(F.col(id_col).eqNullSafe(F.col(keep))).dropDuplicates([sha, id_col]))
    return rows.where(~F.col(flag)).select(*docs.columns).unionByName(stay.select(*docs.columns))
