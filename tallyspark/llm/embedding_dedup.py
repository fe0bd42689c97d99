"""Embedding near-duplicates: exact cosine links by PCA-ordered tiled comparison, counted in place, and their components.

1. Equal vectors are one class with a weight (grouped by two 64-bit hashes, combined before the shuffle); only classes go on.
2. Unit vectors are turned to the principal axes of all vectors (a grouped sum of fixed size), so that leading coordinates hold
   most of each length. Vectors are ordered along a Hilbert curve over the leading coordinates and cut into even tiles.
3. Two tiles are compared only if their boxes allow it: a link at cosine t has a squared distance of at most 2 - 2t, and so have
   the gaps of the boxes' sides in the leading coordinates and of the lengths of the rest. A tile's rows are copied for the
   pairs of tiles that are left, never for pairs of rows.
4. In a task, two tiles meet in blocks. The products of the leading coordinates are accumulated first; with the product of the
   lengths of the suffixes they bound the cosine from above. Pairs whose bound can't reach the threshold are left; the others
   go on through further coordinates, as lists where they are few, else as matrices. Decisions within rounding of the threshold
   are made on the vectors as given, in double precision.
5. A task gives the number of links of each row and a spanning forest of the links, at most one link a row; the links of a large
   group of near copies are counted, not listed. Forests are joined by label propagation.

All links are found: bounds carry a margin above rounding. On vectors without structure no bound on tiles is sharp in high
dimensions; then tiles meet all others, and the work is the square of the distinct vectors, over n / TILE tasks for each tile.

Defined results. Null, zero, empty vectors, and those with null or non-finite components: no links, a component of their own.
Vectors of unequal lengths: the shorter are filled with zeros. Repeated rows: one row each, linked like copies. Null id: linked,
but never a component's id (null if a component has no other), and not kept. Other columns are ignored. Empty table: empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_small, materialise, small_batches
from .components import components
from .simhash import _tree
from .vector_order import block_of, curve_place, even_cuts, finite, matrix, principal_axes

THRESHOLD = 0.9
#: Rows of a tile, about: two of them meet in a task. Small tables are cut into ``LEAST_TILES`` tiles to use more than one core.
TILE = 16_384
LEAST_TILES = 8
#: Coordinates of a tile's box.
BOX = 8
#: Coordinates accumulated before a bound is taken; then the rest.
STAGES = (16, 32)
ROWS, COLS = 512, 4096  # a block of a comparison
#: Share of a block's pairs below which they go on as a list.
SPARSE = 0.05
_SAME = 1e-9  # decisions this near the threshold are made again on the vectors as given


def unit(m: np.ndarray) -> np.ndarray:
    """Rows of length 1, whatever their scale."""
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


class Side:
    """Unit vectors in principal order with the lengths of their suffixes."""

    def __init__(self, units: np.ndarray, axes: np.ndarray):
        self.units, self.turned = units, units @ axes
        width = units.shape[1]
        self.stages = [*[s for s in STAGES if s < width], width]
        tail = np.cumsum((self.turned ** 2)[:, ::-1], 1)[:, ::-1]
        self.rest = {s: np.sqrt(tail[:, s]) if s < width else np.zeros(len(units)) for s in self.stages}
        first = self.stages[0]
        self.lead = np.column_stack([self.turned[:, :first], self.rest[first]]).astype(np.float32)

    def __len__(self) -> int:
        return len(self.units)


def close_pairs(a: Side, b: Side, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Blocks of the links between ``a`` and ``b``: (rows, cols, None) as a list of pairs, or (rows, cols, matrix)."""
    for at in range(0, len(a), ROWS):
        for on in range(0, len(b), COLS):
            bound = a.lead[at:at + ROWS] @ b.lead[on:on + COLS].T
            near = bound >= np.float32(threshold - 1e-4)  # single precision: a wider margin
            found = np.count_nonzero(near)
            if found:
                yield _decided(a, b, at, on, near, found, threshold)


def _decided(a: Side, b: Side, at: int, on: int, near: np.ndarray, found: int, threshold: float):
    """What is left of a block's pairs after the further stages."""
    first = a.stages[0]
    if found <= SPARSE * near.size:
        row, col = np.nonzero(near)
        row, col = row + at, col + on
        sums = np.einsum("ij,ij->i", a.turned[row, :first], b.turned[col, :first])
        done = first
        for stage in a.stages:
            if stage > done:
                sums += np.einsum("ij,ij->i", a.turned[row, done:stage], b.turned[col, done:stage])
            keep = sums + a.rest[stage][row] * b.rest[stage][col] >= threshold - _SAME
            row, col, sums, done = row[keep], col[keep], sums[keep], stage
        unsure = np.flatnonzero(sums < threshold + _SAME)
        keep = np.ones(len(row), bool)
        keep[unsure] = np.einsum("ij,ij->i", a.units[row[unsure]], b.units[col[unsure]]) >= threshold
        return row[keep], col[keep], None
    row, col = np.flatnonzero(near.any(1)) + at, np.flatnonzero(near.any(0)) + on
    sums, done = np.zeros((len(row), len(col))), 0
    for stage in a.stages:
        sums += a.turned[row, done:stage] @ b.turned[col, done:stage].T
        near = sums + np.outer(a.rest[stage][row], b.rest[stage][col]) >= threshold - _SAME
        some, any_col, done = near.any(1), near.any(0), stage
        row, col = row[some], col[any_col]
        sums, near = sums[np.ix_(some, any_col)], near[np.ix_(some, any_col)]
    i, j = np.nonzero(near & (sums < threshold + _SAME))
    near[i, j] = np.einsum("ij,ij->i", a.units[row[i]], b.units[col[j]]) >= threshold
    return row, col, near


def forest(near: np.ndarray, stars: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(row, col) links that connect what a matrix of links connects: its first components as stars, the rest as a list."""
    near = near.copy()
    rows, cols = [], []
    for _ in range(stars):
        some = np.flatnonzero(near.any(1))
        if not len(some):
            break
        own = near[some[0]].copy()
        while True:
            members = near[:, own].any(1)
            grown = near[members].any(0)
            if (grown == own).all():
                break
            own = grown
        members, own = np.flatnonzero(members), np.flatnonzero(own)
        inside = near[np.ix_(members, own)]
        if inside[0].all() and inside[:, 0].all():  # a row and a column that see all stand for the component
            rows += [members, np.full(len(own), members[0])]
            cols += [np.full(len(members), own[0]), own]
        else:
            i, j = np.nonzero(inside)
            rows.append(members[i])
            cols.append(own[j])
        near[members] = False
    i, j = np.nonzero(near)
    return np.concatenate([*rows, i]).astype(np.int64), np.concatenate([*cols, j]).astype(np.int64)


def tile_links(a: Side, a_ids: np.ndarray, a_weights: np.ndarray, b: Side, b_ids: np.ndarray, b_weights: np.ndarray, same: bool,
               threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of each row of ``a`` and of ``b``, counted by weight, and a forest (n, 2) of ids. ``same``: one tile with itself,
    whose rows don't link with themselves."""
    a_count, b_count = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    held, size = [np.zeros((0, 2), np.int64)], 0
    for row, col, near in close_pairs(a, b, threshold):
        if near is None:
            if same:
                row, col = row[row != col], col[row != col]
            a_count += np.bincount(row, b_weights[col], len(a)).astype(np.int64)
            b_count += np.bincount(col, a_weights[row], len(b)).astype(np.int64)
        else:
            if same:
                near = near & (row[:, None] != col[None, :])
            a_count[row] += near @ b_weights[col]
            b_count[col] += a_weights[row] @ near
            i, j = forest(near)
            row, col = row[i], col[j]
        held.append(np.stack([a_ids[row], b_ids[col]], 1))
        size += len(row)
        if size > 1 << 20:
            held = [_tree(np.concatenate(held))]
            size = len(held[0])
    return a_count, b_count, _tree(np.concatenate(held))


def _classes(spark: SparkSession, vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows: id, m1, m2; classes: uid, m1, m2, weight, least, v): rows, and the distinct vectors that can link."""
    kind = vectors.schema[vector_col].dataType.simpleString()
    v = F.col(vector_col) if kind == "array<float>" else F.col(vector_col).cast("array<double>")
    links = finite(v) & F.exists(v, lambda c: c != 0)
    marks = [F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(i), F.col("v"))).alias(f"m{i}") for i in (1, 2)]
    usable = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(links, v).alias("v")).select("*", *marks)
    rows = materialise(spark, usable, "vectors")
    grouped = rows.where("v IS NOT NULL").groupBy("m1", "m2").agg(
        F.count("*").alias("weight"), F.min("id").alias("least"), F.any_value("v").alias("v"))
    classes = materialise(spark, grouped.withColumn("uid", F.monotonically_increasing_id()), "vector-classes")
    return rows.select("id", "m1", "m2"), classes


def _tiles(spark: SparkSession, classes: DataFrame, width: int, axes: np.ndarray, spread: np.ndarray, size: int, tile: int
           ) -> tuple[DataFrame, int]:
    """(uid, weight, v, tile): classes in even tiles along the curve, and the number of tiles."""
    tiles = max(-(-size // tile), min(LEAST_TILES, -(-size // 64)), 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = curve_place(unit(matrix(batch.column("v"), width)) @ axes, spread)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.float64))], names=["uid", "weight", "v", "at"])

    kind = classes.schema["v"].dataType.simpleString()
    placed = materialise(spark, classes.select("uid", "weight", "v").mapInArrow(place, f"uid long, weight long, v {kind}, at double"),
                         "vector-places")
    cuts = even_cuts(placed, "at", tiles)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid = batch.column("uid").to_numpy()
            own = block_of(batch.column("at").to_numpy(), cuts, uid % 1_000_003)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(own.astype(np.int32))], names=["uid", "weight", "v", "tile"])

    return placed.mapInArrow(cut, f"uid long, weight long, v {kind}, tile int"), tiles


def _boxes(tiled: DataFrame, tiles: int, width: int, axes: np.ndarray) -> np.ndarray:
    """(tiles, sides, 2): least and greatest leading coordinates of each tile, and of the length of the rest (a fixed number of
    values a tile)."""
    sides = min(BOX, width) + 1

    def corners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full((tiles, sides), np.inf), np.full((tiles, sides), -np.inf)
        for batch in batches:
            turned, own = unit(matrix(batch.column("v"), width)) @ axes, batch.column("tile").to_numpy()
            values = np.column_stack([turned[:, :sides - 1], np.sqrt((turned[:, sides - 1:] ** 2).sum(1))])
            np.minimum.at(low, own, values)
            np.maximum.at(high, own, values)
        tile, side = np.nonzero(np.isfinite(low))
        yield pa.RecordBatch.from_pydict({"tile": tile, "side": side, "low": low[tile, side], "high": high[tile, side]})

    found = (tiled.select("tile", "v").mapInArrow(corners, "tile long, side long, low double, high double")
             .groupBy("tile", "side").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow())
    boxes = np.full((tiles, sides, 2), np.nan)  # a tile without rows is near none
    at = found["tile"].to_numpy(), found["side"].to_numpy()
    boxes[at[0], at[1], 0], boxes[at[0], at[1], 1] = found["low"].to_numpy(), found["high"].to_numpy()
    return boxes


def partners(boxes: np.ndarray, tile: int, threshold: float) -> np.ndarray:
    """The tiles whose boxes are near enough to the tile's for a link (itself included)."""
    gap = np.maximum(boxes[:, :, 0] - boxes[tile, :, 1], boxes[tile, :, 0] - boxes[:, :, 1])
    return np.flatnonzero((np.maximum(gap, 0) ** 2).sum(1) <= 2 - 2 * threshold + 1e-9)


def near_vectors(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per vector: ``id_col``, n_links (other rows at a cosine of at least ``threshold``), component_id (the smallest id
    reachable), kept (whether it is the row's own)."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    small_batches(spark)
    rows, classes = _classes(spark, vectors, id_col, vector_col)
    width, size = classes.agg(F.max(F.size("v")), F.count("*")).first()
    width = max(width or 0, 1)
    axes, spread = principal_axes(classes, "v", width, unit)
    tiled, tiles = _tiles(spark, classes, width, axes, spread, size, tile)
    tiled = materialise(spark, tiled, "vector-tiles")
    boxes = _boxes(tiled, tiles, width, axes)
    kind = classes.schema["v"].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            own = batch.column("tile").to_numpy()
            for t in np.unique(own).tolist():
                if t not in known:
                    known[t] = partners(boxes, t, threshold)
                mine = pa.array(np.flatnonzero(own == t))
                part = batch.take(mine)
                for other in known[t].tolist():
                    n = len(mine)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, min(t, other), np.int32)), pa.array(np.full(n, max(t, other), np.int32)), *part.columns],
                        names=["lo", "hi", "uid", "weight", "v", "tile"])

    def meet(key: tuple, both: pa.Table) -> pa.Table:
        lo, hi = (k.as_py() for k in key)
        own = both["tile"].to_numpy()
        sides = []
        for t in (lo, hi)[:1 if lo == hi else 2]:
            part = both.filter(pa.array(own == t))
            sides.append((Side(unit(matrix(part["v"], width)), axes), part["uid"].to_numpy(), part["weight"].to_numpy()))
        a, b = sides[0], sides[-1]
        a_count, b_count, links = tile_links(*a, *b, lo == hi, threshold)
        counted = [(a[1], a_count)] if lo == hi else [(a[1], a_count), (b[1], b_count)]
        uids, n = (np.concatenate([x[i] for x in counted]) for i in (0, 1))
        some = n > 0
        uids, n = uids[some], n[some]
        return pa.table({"a": np.concatenate([uids, links[:, 0]]),
                         "b": pa.array(np.concatenate([uids, links[:, 1]]), mask=np.arange(len(uids) + len(links)) < len(uids)),
                         "n": np.concatenate([n, np.zeros(len(links), np.int64)])})

    dealt = tiled.mapInArrow(deal, f"lo int, hi int, uid long, weight long, v {kind}, tile int")
    found = materialise(spark, dealt.groupBy("lo", "hi").applyInArrow(meet, "a long, b long, n long"), "vector-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("uid")).agg(F.sum("n").alias("n"))
    roots = components(spark, found.where("b IS NOT NULL").select("a", "b")).select(F.col("node").alias("uid"), "root")
    members = roots.join(classes.select("uid", "least"), "uid")
    least = members.groupBy("root").agg(F.min("least").alias("component"))
    joined = members.join(least, "root").select("uid", "component", F.lit(True).alias("linked"))
    told = (classes.select("uid", "m1", "m2", "weight", "least").join(counts, "uid", "left").join(joined, "uid", "left")
            .select("m1", "m2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                    F.when(F.col("linked"), F.col("component")).otherwise(F.col("least")).alias("component_id")))
    told = materialise(spark, told, "vector-members")
    named = join_small(rows, told, ["m1", "m2"])
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return named.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
