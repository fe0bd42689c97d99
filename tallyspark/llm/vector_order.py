"""Order of vectors for block-wise operators: principal axes, the Hilbert curve, and cuts into blocks of even size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether the vector is there and has finite components only."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def matrix(column, width: int) -> np.ndarray:
    """The vectors of an Arrow list column as float64 rows, filled with zeros up to ``width``."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def principal_axes(vectors: DataFrame, column: str, width: int, prepare: Callable[[np.ndarray], np.ndarray] = np.asarray
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal axes (columns) by descending second moment of all vectors (as ``prepare`` makes them), and the root mean
    squares along them. The moments are a sum over all rows of a fixed width x width matrix."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((width, width)), 0
        for batch in batches:
            m = prepare(matrix(batch.column(0), width))
            total, rows = total + m.T @ m, rows + len(m)
        if rows:
            yield pa.RecordBatch.from_pydict({"at": np.arange(width * width + 1), "x": np.append(total.ravel(), rows)})

    sums = vectors.select(column).mapInArrow(moments, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).toArrow()
    found = np.zeros(width * width + 1)
    found[sums["at"].to_numpy()] = sums["x"].to_numpy()
    values, axes = np.linalg.eigh(found[:-1].reshape(width, width))
    return axes[:, ::-1], np.sqrt(np.maximum(values[::-1], 0) / max(found[-1], 1))


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of non-negative integer coordinates below 2 ** bits (dimensions x bits at most 62).

    From the highest bit down, each coordinate's bit says which half it is in; the half's reflection and rotation are undone for
    the lower bits, and the bits, Gray-decoded, make the index."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dims):
            upper = (x[d] >> level) & 1 == 1
            swap = np.where(upper, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn
    index = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            index = index << 1 | (x[d] >> level) & 1
    return index


def curve_place(turned: np.ndarray, spread: np.ndarray, dims: int = 8, bits: int = 6) -> np.ndarray:
    """The curve's index of rows in principal coordinates: the leading ones in cells over three deviations either way."""
    dims = min(dims, turned.shape[1])
    scale = np.where(spread[:dims] > 0, spread[:dims], 1.0)
    cells = np.floor((turned[:, :dims] / scale / 6 + 0.5) * (1 << bits))
    return hilbert_index(np.clip(cells, 0, (1 << bits) - 1), bits)


def even_cuts(df: DataFrame, column: str, blocks: int) -> np.ndarray:
    """Ascending values that cut ``df`` into about even blocks by ``column``; a value that many rows share is repeated."""
    if blocks < 2:
        return np.zeros(0)
    found = df.approxQuantile(column, [i / blocks for i in range(1, blocks)], min(0.01, 0.1 / blocks))
    return np.sort(np.array(found, np.float64))


def block_of(value: np.ndarray, cuts: np.ndarray, deal: np.ndarray) -> np.ndarray:
    """The block of each value; rows of a value that spans several blocks are dealt over them by ``deal``."""
    low, high = np.searchsorted(cuts, value, "left"), np.searchsorted(cuts, value, "right")
    return low + deal % (high - low + 1)
