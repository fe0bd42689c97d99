"""Hard-negative mining over candidate blocks in Hilbert-curve order with zone maps.

Vectors are made integer: floor(scale * x). Anchors are the rows whose id is divisible by ``every``; an anchor's positives are
its best ``positives`` other rows of its label by inner product; for each of them, the hard negatives are the best ``negatives``
rows of other labels whose score is between ``low`` percent of the positive's score and that score.

1. Candidates are turned to the principal axes, ordered along a Hilbert curve over the leading coordinates and written as Parquet
   in even blocks (``partitionBy``, so that a block that no anchor asks for isn't read).
2. A block's zone map holds the least and greatest value of each turned coordinate and the greatest length in the coordinates
   after the leading ones. Interval arithmetic on it gives bounds of an anchor's scores with all rows of the block.
3. Each anchor reads its own block first, the one where the curve places it: that gives a first bound for its positives. It then
   reads the blocks whose upper bound reaches that, and has its positives.
4. Its windows (one for each positive) are intervals of scores; it reads the blocks whose score interval meets one of them, its
   own block first again: a window that is full there needs only blocks that can beat its worst score.
5. A task holds a part of a block (at most ``PART`` rows) and a chunk of the anchors that ask for it (at most ``CHUNK`` about), scores them in
   integers, and gives each window's best; these are ranked. Anchors are copied for their blocks, candidates for the chunks.

Bounds have a margin above rounding, and scores are exact, so the results are those of a full search. On vectors without
structure the bounds are wide in high dimensions and most blocks are read.

Defined results. Rows with a null label, a null vector, or null or non-finite components take no part. Vectors of unequal lengths:
the shorter are filled with zeros. Empty vectors: scores 0. Rows with the anchor's id are left out of its results. Repeated ids: each row
takes part. Null ids take no part. Equal scores: the smaller id first. Scores beyond a long: an error. Other columns are ignored.
Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_path, join_small, materialise, small_batches
from .vector_order import block_of, curve_place, even_cuts, finite, matrix, principal_axes

SCALE = 256
EVERY = 100
POSITIVES = 5
NEGATIVES = 5
LOW_PERCENT = 80
#: Rows of a block, about, until there are ``MOST_BLOCKS``; then blocks grow, and are scored in parts.
BLOCK = 4096
MOST_BLOCKS = 4096
PART = 16_384
CHUNK = 1024
LEAD = 16


def usable(vectors: DataFrame, label: Column, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, label, v): the rows that take part, with integer vectors. A component that no long holds makes an error."""
    x = F.col(vector_col).cast("array<double>")
    scaled = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    far = F.exists(x, lambda c: F.abs(c) * F.lit(float(scale)) >= F.lit(9.2e18))
    whole = F.when(far, F.raise_error(F.lit("a component is beyond the range of a long")).cast("array<bigint>")).otherwise(scaled)
    rows = vectors.where(F.col(id_col).isNotNull() & label.isNotNull() & finite(x))
    return rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("v"))


class Zones:
    """The blocks' zone maps, in principal coordinates."""

    def __init__(self, low: np.ndarray, high: np.ndarray, rest: np.ndarray, lead: int):
        self.low, self.high, self.rest, self.lead = low, high, rest, lead

    def bounds(self, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchors, blocks): least and greatest score of each anchor (in principal coordinates) with a block's rows."""
        plus, minus = np.maximum(turned, 0), np.minimum(turned, 0)
        lead, n = slice(0, self.lead), self.lead
        upper = plus[:, lead] @ self.high[:, lead].T + minus[:, lead] @ self.low[:, lead].T
        lower = plus[:, lead] @ self.low[:, lead].T + minus[:, lead] @ self.high[:, lead].T
        length = np.sqrt((turned[:, n:] ** 2).sum(1))
        by_length = np.outer(length, self.rest)
        upper_rest = plus[:, n:] @ self.high[:, n:].T + minus[:, n:] @ self.low[:, n:].T
        lower_rest = plus[:, n:] @ self.low[:, n:].T + minus[:, n:] @ self.high[:, n:].T
        size = np.sqrt((turned ** 2).sum(1))[:, None] * np.sqrt((np.maximum(np.abs(self.low), np.abs(self.high)) ** 2).sum(1))
        margin = 1e-9 * size + 1e-6
        return (lower + np.maximum(lower_rest, -by_length) - margin, upper + np.minimum(upper_rest, by_length) + margin)


def zone_maps(placed: DataFrame, blocks: int, width: int, axes: np.ndarray, lead: int) -> Zones:
    """From all rows (block, v); 2 x ``width`` + 1 values a block come to the driver, of at most ``MOST_BLOCKS`` blocks."""

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full((blocks, width + 1), np.inf), np.full((blocks, width + 1), -np.inf)
        for batch in batches:
            turned, own = matrix(batch.column("v"), width) @ axes, batch.column("block").to_numpy()
            values = np.column_stack([turned, np.sqrt((turned[:, lead:] ** 2).sum(1))])
            order = np.argsort(own, kind="stable")
            starts = np.flatnonzero(np.diff(own[order], prepend=-1))
            at = own[order][starts]
            low[at] = np.minimum(low[at], np.minimum.reduceat(values[order], starts))
            high[at] = np.maximum(high[at], np.maximum.reduceat(values[order], starts))
        block, side = np.nonzero(np.isfinite(low))
        yield pa.RecordBatch.from_pydict({"block": block, "side": side, "low": low[block, side], "high": high[block, side]})

    found = (placed.select("block", "v").mapInArrow(extremes, "block long, side long, low double, high double")
             .groupBy("block", "side").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow())
    low, high = np.zeros((blocks, width + 1)), np.zeros((blocks, width + 1))
    at = found["block"].to_numpy(), found["side"].to_numpy()
    low[at], high[at] = found["low"].to_numpy(), found["high"].to_numpy()
    return Zones(low[:, :-1], high[:, :-1], high[:, -1], lead)


def whole_matrix(column, width: int) -> np.ndarray:
    """Integer vectors as int64 rows."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < np.diff(lists.offsets.to_numpy())[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of int64 rows: in floating point where every partial sum is a whole double, else in long
    arithmetic. An error where a score may leave a long's range."""
    largest = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * a.shape[1]
    if largest < 2.0 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if largest >= 2.0 ** 63:
        sizes = np.abs(a.astype(np.float64)) @ np.abs(b.T.astype(np.float64))
        if sizes.max(initial=0) >= 2.0 ** 62.9:
            raise OverflowError("a score is beyond the range of a long")
    return a @ b.T


def best_of_label(score: np.ndarray, allowed: np.ndarray, ids: np.ndarray, floor: np.ndarray, k: int) -> list[np.ndarray]:
    """Per anchor, the columns of its best k allowed scores that reach its floor."""
    out = []
    for row, may, least in zip(score, allowed, floor, strict=True):
        at = np.flatnonzero(may & (row >= least))
        if len(at) > 8 * k:
            at = at[row[at] >= np.partition(row[at], -k)[-k]]
        out.append(at[np.lexsort((ids[at], -row[at]))[:k]])
    return out


def within(score: np.ndarray, positive: int, low_percent: int) -> np.ndarray:
    """Which of the scores are in the positive's window. Only for scores of at most 2^56; larger ones by Python's integers."""
    if max(abs(int(positive)), int(np.abs(score).max(initial=0))) < 1 << 56:
        return (100 * score >= low_percent * positive) & (score <= positive)
    return np.array([low_percent * int(positive) <= 100 * int(s) <= 100 * int(positive) for s in score], bool)


class Search:
    """The blocks of one table and what to ask them."""

    def __init__(self, spark: SparkSession, candidates: DataFrame, parts: int):
        self.spark, self.candidates, self.parts = spark, candidates, parts

    def ask(self, anchors: DataFrame, fields: str, find, schema: str) -> DataFrame:
        """``find(anchors, candidates)`` for each part of a block and each chunk of the anchors that name the block in ``blocks``."""
        asked = materialise(self.spark, anchors.select("*", F.explode("blocks").alias("block")).drop("blocks"), "anchor-blocks")
        chunks = materialise(self.spark, asked.groupBy("block").agg(F.collect_set("chunk").alias("chunks")), "block-chunks")
        wanted = [r.block for r in chunks.select("block").collect()]  # at most MOST_BLOCKS: the others aren't read
        asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1))))
        read = join_small(self.candidates.where(F.col("block").isin(wanted)), chunks, "block", "inner", entries=F.size("chunks"))
        rows = read.select("id", "label", "v", "block", F.pmod(F.xxhash64("id", "v"), F.lit(self.parts)).cast("int").alias("part"),
                           F.explode("chunks").alias("chunk"))
        names = [c.split()[0] for c in fields.split(", ")]
        keys = ["block", "part", "chunk"]
        names = [n for n in names if n not in keys]
        return (asked.select(*keys, *names).groupBy(*keys).cogroup(rows.select(*keys, "id", "label", "v").groupBy(*keys))
                .applyInArrow(lambda left, right: find(left, right), schema))


def mine(spark: SparkSession, vectors: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT,
         scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score."""
    small_batches(spark)
    rows = materialise(spark, usable(vectors, label, id_col, vector_col, scale), "mining-rows")
    largest = F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v")))
    width, size, most = rows.agg(F.max(F.size("v")), F.count("*"), F.max(largest)).first()
    width, size = max(width or 0, 1), size or 0
    kind = "int" if (most or 0) < 1 << 31 else "bigint"
    axes, spread = principal_axes(rows, "v", width)
    blocks = max(1, min(MOST_BLOCKS, -(-size // block)))
    parts = max(1, -(-size // (blocks * PART)))
    lead = min(LEAD, width)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = curve_place(matrix(batch.column("v"), width) @ axes, spread)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.float64))], names=["id", "label", "v", "at"])

    on_curve = materialise(spark, rows.select("id", "label", F.col("v").cast(f"array<{kind}>").alias("v"))
                           .mapInArrow(place, f"id long, label long, v array<{kind}>, at double"), "mining-curve")
    cuts = even_cuts(on_curve, "at", blocks)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = block_of(batch.column("at").to_numpy(), cuts, batch.column("id").to_numpy() // every)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(own.astype(np.int32))], names=["id", "label", "v", "block"])

    schema = f"id long, label long, v array<{kind}>, block int"
    path = fresh_path(spark, "mining-blocks")
    on_curve.mapInArrow(cut, schema).repartition(F.col("block")).write.partitionBy("block").parquet(path)
    candidates = spark.read.schema(schema).parquet(path)
    zones = zone_maps(candidates, blocks, width, axes, lead)
    anchors = materialise(spark, candidates.where(F.pmod("id", F.lit(every)) == 0)
                          .withColumn("uid", F.monotonically_increasing_id()), "mining-anchors")
    # anchors of a chunk are neighbours on the curve, so they ask for about the same blocks
    chunks = max(1, -(-anchors.count() // CHUNK))
    inside = F.pmod(F.xxhash64("uid"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    anchors = anchors.withColumn("chunk", F.floor((F.col("block") + inside) * chunks / blocks).cast("int"))
    search = Search(spark, candidates, parts)
    who = f"uid long, chunk int, id long, label long, v array<{kind}>"

    # --- positives ---------------------------------------------------------------------------------------------------

    def same_label(left: pa.Table, right: pa.Table) -> pa.Table:
        score = scores(whole_matrix(left["v"], width), whole_matrix(right["v"], width))
        a_ids, ids = left["id"].to_numpy(), right["id"].to_numpy()
        allowed = (left["label"].to_numpy()[:, None] == right["label"].to_numpy()) & (a_ids[:, None] != ids)
        floor = left["floor"].to_numpy()
        found = best_of_label(score, allowed, ids, floor, positives)
        row = np.repeat(np.arange(len(found)), [len(x) for x in found])
        col = np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64)
        return pa.table({"uid": left["uid"].to_numpy()[row], "other": ids[col], "score": score[row, col]})

    found_type = "uid long, other long, score long"
    best = Window.partitionBy("uid").orderBy(F.desc("score"), "other")
    none = F.lit(-(1 << 63))
    home = anchors.withColumn("floor", none).withColumn("blocks", F.array("block")).drop("block")
    at_home = materialise(spark, _first(search.ask(home, who + ", floor long", same_label, found_type), best, positives), "mining-home")
    floors = at_home.groupBy("uid").agg(F.when(F.count("*") == positives, F.min("score")).alias("floor"))

    def reaching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upper = zones.bounds(matrix(batch.column("v"), width) @ axes)[1]
            own, floor = batch.column("block").to_numpy(), batch.column("floor").to_numpy()
            need = upper >= floor[:, None]
            need[np.arange(len(own)), own] = False  # read already
            yield _with_blocks(batch, need, ["uid", "chunk", "id", "label", "v", "floor"])

    asking = anchors.join(floors, "uid", "left").withColumn("floor", F.coalesce("floor", none)).mapInArrow(
        reaching, who + ", floor long, blocks array<int>")
    further = search.ask(asking, who + ", floor long", same_label, found_type)
    chosen = materialise(spark, _first(at_home.drop("rank").unionByName(further), best, positives), "mining-positives")

    # --- negatives: a window for each positive -----------------------------------------------------------------------

    lists = chosen.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("rank", "other", "score"))).alias("p"))  # at most `positives`
    windows = materialise(spark, anchors.join(lists, "uid").select(
        "uid", "chunk", "id", "label", "v", "block", F.col("p.rank").alias("ranks"), F.col("p.other").alias("others"), F.col("p.score").alias("tops")),
        "mining-windows")
    ask_type = who + ", ranks array<int>, tops array<bigint>, floors array<bigint>"
    hit_type = "uid long, p_rank int, other long, score long"

    def in_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        score = scores(whole_matrix(left["v"], width), whole_matrix(right["v"], width))
        ids, labels = right["id"].to_numpy(), right["label"].to_numpy()
        a_ids, a_labels, uids = (left[c].to_numpy() for c in ("id", "label", "uid"))
        out: list = []
        for i, (ranks, tops, floors_) in enumerate(zip(left["ranks"].to_pylist(), left["tops"].to_pylist(), left["floors"].to_pylist(), strict=True)):
            row = score[i]
            # a window's scores are its floor at least and its top at most, so one selection and one sort serve all windows
            at = np.flatnonzero((row >= min(floors_)) & (row <= max(tops)) & (labels != a_labels[i]) & (ids != a_ids[i]))
            at = at[np.lexsort((ids[at], -row[at]))]
            own = row[at]
            for rank, top, floor in zip(ranks, tops, floors_, strict=True):
                keep = at[np.searchsorted(-own, -top, "left"):np.searchsorted(-own, -floor, "right")]
                keep = keep[within(row[keep], top, low_percent)][:negatives] if len(keep) else keep
                out += [(uids[i], rank, ids[j], row[j]) for j in keep]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.table({"uid": pa.array(columns[0], pa.int64()), "p_rank": pa.array(columns[1], pa.int32()),
                         "other": pa.array(columns[2], pa.int64()), "score": pa.array(columns[3], pa.int64())})

    least = F.transform("tops", lambda t: F.ceil(t * F.lit(low_percent).cast("decimal(20,0)") / 100).cast("bigint"))
    own_block = windows.withColumn("floors", least).withColumn("blocks", F.array("block")).drop("block")
    per_window = Window.partitionBy("uid", "p_rank").orderBy(F.desc("score"), "other")
    near = materialise(spark, _first(search.ask(own_block, ask_type, in_windows, hit_type), per_window, negatives), "mining-near")
    full = near.groupBy("uid", "p_rank").agg(F.count("*").alias("n"), F.min("score").alias("worst")).where(F.col("n") == negatives)
    full = full.groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct("p_rank", "worst"))).alias("worst"))  # a window each
    raised = F.zip_with("ranks", least, lambda r, low: F.greatest(low, F.coalesce(F.element_at("worst", r), low)))
    floored = windows.join(full, "uid", "left").withColumn("floors", F.when(F.col("worst").isNull(), least).otherwise(raised))

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = zones.bounds(matrix(batch.column("v"), width) @ axes)
            own = batch.column("block").to_numpy()
            tops, floors_ = matrix(batch.column("tops"), positives), matrix(batch.column("floors"), positives)
            counts = np.diff(batch.column("tops").offsets.to_numpy())
            need = np.zeros(low.shape, bool)
            for p in range(positives):  # the windows' ends as doubles: a margin for their rounding
                slack = 1e-12 * np.abs(tops[:, p:p + 1]) + 1
                need |= ((counts > p)[:, None] & (tops[:, p:p + 1] >= floors_[:, p:p + 1] - slack)
                         & (high >= floors_[:, p:p + 1] - slack) & (low <= tops[:, p:p + 1] + slack))
            need[np.arange(len(own)), own] = False
            yield _with_blocks(batch, need, ["uid", "chunk", "id", "label", "v", "ranks", "tops", "floors"])

    asking = floored.select("uid", "chunk", "id", "label", "v", "block", "ranks", "tops", "floors").mapInArrow(
        meeting, ask_type + ", blocks array<int>")
    further = search.ask(asking, ask_type, in_windows, hit_type)
    hits = _first(near.drop("rank").unionByName(further), per_window, negatives)
    named = chosen.select("uid", F.col("rank").alias("p_rank"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = anchors.select("uid", F.col("id").alias("anchor_id"))
    return (hits.join(named, ["uid", "p_rank"]).join(ids, "uid")
            .select("anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def _first(found: DataFrame, order, k: int) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _with_blocks(batch: pa.RecordBatch, need: np.ndarray, names: list[str]) -> pa.RecordBatch:
    row, block = np.nonzero(need)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(need)))]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(block.astype(np.int32)))
    return pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], lists], names=[*names, "blocks"])
