"""Exact top-k by inner product: norm-sorted vectors, SVD-rotated partial sums, Cauchy-Schwarz residual bounds.

Vectors are made integer: floor(scale * x). The rotation comes from the singular vectors of all vectors (the eigenvectors
of their Gram matrix, a sum over all rows of fixed size d x d): it keeps inner products and gathers most of a
vector's length in the leading coordinates.

1. The ``HEAD`` longest vectors give each query a first k-th best score, exact.
2. A vector c can enter a query's best k only if |c| |q| reaches that score. Queries are cut into blocks by this least
   length, so that the queries of a block need about the same vectors, and a vector goes only to the blocks that can use it.
3. In a task, one block of queries meets vectors in descending length, tile by tile. A query leaves off once the next tile's
   length can't reach its score. Of a tile, the partial sums over the ``LEAD`` leading coordinates plus the product of the
   residual lengths bound each score from above; only pairs that reach the query's score are computed in
   full, in integers. Bounds have a margin above rounding, so no pair is lost.
4. The tasks' best k per query are ranked.

Queries and vectors meet in blocks; no pair is output but the tasks' best k. Equal vectors (any number) only tie, and ties go
to the smaller id.

Defined results. Null vectors, and those holding null or non-finite components, take no part. Vectors of unequal lengths:
the shorter are filled with zeros. Empty vectors: scores 0. Components and scores are longs, exact; one beyond a long is an error.
Repeated ids: each row takes part, and rows with the query's id are left out of its results. Null ids take no part.
Other columns are ignored. Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise

K = 5
SCALE = 256
EVERY = 50
HEAD = 2048
LEAD = 16
TILE = 1024
QUERY_BLOCK = 1024
#: Vectors of a task, about: a block's vectors are dealt to so many that each gets this number.
CHUNK = 32_768


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, v): the integer vectors that take part. A component that no long holds makes an error."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    far = F.exists(x, lambda c: F.abs(c) * F.lit(float(scale)) >= F.lit(9.2e18))
    whole = F.when(far, F.raise_error(F.lit("a component is beyond the range of a long")).cast("array<bigint>")).otherwise(
        F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~F.coalesce(bad, F.lit(True)))
            .select(F.col(id_col).cast("long").alias("id"), whole.alias("v")))


def _matrix(column, width: int, kind: type | None = np.float64) -> np.ndarray:
    """The vectors of an Arrow list column, filled with zeros up to ``width``."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if kind is not None:
        flat = flat.astype(kind)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes])] = flat
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Orthonormal columns, by descending singular value of all vectors."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column("v"), width)
            total += m.T @ m
        yield pa.RecordBatch.from_pydict({"at": np.arange(width * width), "x": total.ravel()})

    sums = vectors.select("v").mapInArrow(gram, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).toArrow()
    total = np.zeros(width * width)
    total[sums["at"].to_numpy()] = sums["x"].to_numpy()
    return np.linalg.eigh(total.reshape(width, width))[1][:, ::-1]


def _products(q: np.ndarray, c: np.ndarray, wide: bool) -> np.ndarray:
    """Exact inner products of rows of longs, pair by pair; in Python's integers where sums may pass a long (``wide``), and an error
    where one is beyond it."""
    if wide:
        return np.array([sum(map(int.__mul__, a, b)) for a, b in zip(q.tolist(), c.tolist(), strict=True)], np.int64)
    return (q * c).sum(1)


def search_block(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, c: np.ndarray, c_ids: np.ndarray, turn: np.ndarray,
                 k: int = K, lead: int = LEAD, tile: int = TILE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score): each query's best k of ``c``, but for those below its ``floor``, a k-th best score known."""
    q_whole, c_whole = q.astype(np.int64), c.astype(np.int64)
    q, c = q.astype(np.float64), c.astype(np.float64)
    wide = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1] >= 2.0 ** 62
    length = np.sqrt((c * c).sum(1))
    order = np.lexsort((c_ids, -length))
    c, c_whole, c_ids, length = c[order], c_whole[order], c_ids[order], length[order]
    q_length = np.sqrt((q * q).sum(1))
    q_turned, c_turned = q @ turn, c @ turn
    q_rest = np.sqrt((q_turned[:, lead:] ** 2).sum(1))
    c_rest = np.sqrt((c_turned[:, lead:] ** 2).sum(1))
    least = floor.copy()
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in q]
    for at in range(0, len(c), tile):
        margin = 1e-9 * q_length * length[at] + 1e-6
        live = np.flatnonzero(q_length * length[at] + margin >= least)
        if not len(live):
            break
        own = slice(at, at + tile)
        bound = q_turned[live, :lead] @ c_turned[own, :lead].T + np.outer(q_rest[live], c_rest[own])
        row, col = np.nonzero(bound + margin[live, None] >= least[live, None])
        row = live[row]
        col += at
        other = q_ids[row] != c_ids[col]
        row, col = row[other], col[other]
        score = np.zeros(len(row), np.int64)
        for part in range(0, len(row), 1 << 18):  # bounded memory
            part = slice(part, part + (1 << 18))
            score[part] = _products(q_whole[row[part]], c_whole[col[part]], wide)
        keep = score + margin[row] >= least[row]
        row, col, score = row[keep], col[keep], score[keep]
        edges = np.flatnonzero(np.diff(row)) + 1  # rows ascend
        for mine in np.split(np.arange(len(row)), edges) if len(row) else []:
            r = row[mine[0]]
            s, i = np.concatenate([found[r][0], score[mine]]), np.concatenate([found[r][1], c_ids[col[mine]]])
            best = np.lexsort((i, -s))[:k]
            found[r] = s[best], i[best]
            if len(best) == k:
                least[r] = max(least[r], found[r][0][-1])
    rows = np.concatenate([np.full(len(s), r) for r, (s, _) in enumerate(found)] or [np.zeros(0)]).astype(int)
    ids = np.concatenate([i for _, i in found] or [np.zeros(0, np.int64)])
    return rows, ids, np.concatenate([s for s, _ in found] or [np.zeros(0, np.int64)])


def top_inner(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
              every: int = EVERY, k: int = K, scale: int = SCALE, head: int = HEAD) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the best k other rows of each row whose id is divisible by ``every``."""
    ints = materialise(spark, usable(vectors, id_col, vector_col, scale), "vectors")
    largest = F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v")))
    width, rows, most = ints.agg(F.max(F.size("v")), F.count("*"), F.max(largest)).first()
    kind = "int" if (most or 0) < 1 << 31 else "bigint"
    ints = ints.withColumn("v", F.col("v").cast(f"array<{kind}>"))
    width = max(width or 0, 1)
    squares = F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x)
    lengths = ints.select("id", "v", F.sqrt(squares).alias("length"))
    turn = rotation(ints, width)
    lead = min(LEAD, width)
    longest = lengths.orderBy(F.desc("length"), "id").limit(head).toArrow()  # a fixed number of vectors
    top, top_ids = _matrix(longest["v"], width), longest["id"].to_numpy()

    top_length = np.sqrt((top * top).sum(1)).max(initial=0)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, ids = _matrix(batch.column("v"), width), batch.column("id").to_numpy()
            floor = np.full(len(q), -np.inf)
            for at in range(0, len(q), 512):
                score = q[at:at + 512] @ top.T
                score[ids[at:at + 512, None] == top_ids[None, :]] = -np.inf
                if score.shape[1] >= k:
                    floor[at:at + 512] = np.partition(score, -k, 1)[:, -k]
            size = np.sqrt((q * q).sum(1))
            floor -= 1e-12 * size * (top_length if top_length * size.max(initial=0) >= 2.0 ** 53 else 0.0)  # rounding of large sums
            need = np.where(np.isfinite(floor) & (floor > 0), floor / np.maximum(size, 1e-300) * (1 - 1e-9) - 1e-6, -1.0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(floor), pa.array(need)],
                                             names=["id", "v", "floor", "need"])

    queries = materialise(spark, ints.where(F.pmod("id", F.lit(every)) == 0).mapInArrow(
        first, f"id long, v array<{kind}>, floor double, need double").withColumn("uid", F.monotonically_increasing_id()), "queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    cuts = sorted(queries.approxQuantile("need", [i / blocks for i in range(1, blocks)], 0.001)) if blocks > 1 else []
    # a query's block: how many cuts its need reaches; equal needs are dealt over all the blocks they might be in
    cut = F.lit(cuts).cast("array<double>")
    low, high = F.size(F.filter(cut, lambda x: x < F.col("need"))), F.size(F.filter(cut, lambda x: x <= F.col("need")))
    dealt = materialise(spark, queries.withColumn("block", (low + F.pmod(F.xxhash64("uid"), high - low + 1)).cast("int")),
                        "query-blocks")
    needs = dealt.groupBy("block").agg(F.min("need").alias("need")).orderBy("need", "block").collect()  # a value a block
    ranked = F.lit([r.need for r in needs]).cast("array<double>")
    numbers = F.lit([r.block for r in needs]).cast("array<int>")
    shares = max(1, -(-rows // CHUNK))
    wanted = F.slice(numbers, F.lit(1), F.size(F.filter(ranked, lambda x: x <= F.col("length"))))
    candidates = (lengths.withColumn("share", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shares)).cast("int"))
                  .select("id", "v", "share", F.explode(wanted).alias("block")))
    spread = dealt.select("id", "uid", "v", "floor", "block", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))

    def meet(key, left: pa.Table, right: pa.Table) -> pa.Table:
        q, c = _matrix(left["v"], width, None), _matrix(right["v"], width, None)  # whole numbers as they are
        q_ids, c_ids = left["id"].to_numpy(), right["id"].to_numpy()
        row, ids, score = search_block(q, q_ids, left["floor"].to_numpy(), c, c_ids, turn, k, lead)
        return pa.table({"uid": left["uid"].to_numpy()[row], "query_id": q_ids[row], "vec_id": ids, "score": score})

    found = (spread.groupBy("block", "share").cogroup(candidates.groupBy("block", "share"))
             .applyInArrow(meet, "uid long, query_id long, vec_id long, score long"))
    best = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
