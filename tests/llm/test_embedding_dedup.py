import math

import numpy as np
import pytest

from tallyspark.llm import embedding_dedup as ed
from tallyspark.llm.vector_order import block_of, hilbert_index


def brute(rows, threshold=0.9):
    """The same by all pairs: rows are (id, vector)."""
    width = max((len(v) for _, v in rows if v is not None), default=0)
    ok = [v is not None and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v) for _, v in rows]
    m = np.array([np.pad(np.array(v, float), (0, width - len(v))) if o else np.zeros(width) for (_, v), o in zip(rows, ok, strict=True)])
    m = m.reshape(len(rows), width)
    m = m / np.maximum(np.abs(m).max(1, keepdims=True, initial=0), 1e-320)
    norm = np.sqrt((m * m).sum(1))
    cos = m @ m.T / np.maximum(np.outer(norm, norm), 1e-300)
    near = (cos >= threshold) & np.array(ok)[:, None] & np.array(ok)[None, :]
    np.fill_diagonal(near, False)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i, j in zip(*np.nonzero(near), strict=True):
        label[root(i)] = root(j)
    least = {}
    for i, (x, _) in enumerate(rows):
        if x is not None:
            least[root(i)] = min(least.get(root(i), x), x)
    return sorted(((x, int(near[i].sum()), least.get(root(i)), x is not None and least.get(root(i)) == x) for i, (x, _) in enumerate(rows)), key=str)


def got(spark, rows, kind="float", **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], f"vec_id long, embedding array<{kind}>, kept string, tile int").repartition(3)
    return sorted((tuple(r) for r in ed.near_vectors(spark, df, **kw).collect()), key=str)


def clustered(rng, n, width, groups, noise):
    """Random vectors and groups of near copies, some chained: neighbours link, ends don't."""
    rows = [v for v in rng.normal(size=(n, width))]
    for _ in range(groups):
        centre = rng.normal(size=width)
        rows += [centre + noise * rng.normal(size=width) for _ in range(int(rng.integers(2, 30)))]
    a, b = rng.normal(size=(2, width))
    rows += [a * math.cos(t) + b * math.sin(t) for t in np.linspace(0, 3, 30)]
    return [[float(np.float32(x)) for x in v] for v in rows]


@pytest.mark.parametrize("tile", [16, 100, 5000])
def test_equals_brute_force(spark, tile):
    rng = np.random.default_rng(tile)
    vectors = clustered(rng, 150, 40, 6, 0.2)
    vectors += [vectors[3]] * 5 + [[2 * x for x in vectors[3]], [-x for x in vectors[3]]]
    ids = rng.permutation(len(vectors)) * 3 - 100
    rows = [(int(i), v) for i, v in zip(ids, vectors, strict=True)]
    want = brute(rows)
    assert got(spark, rows, tile=tile) == want
    assert sum(r[1] for r in want) > 500 and sum(r[3] for r in want) < len(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, [1.0, None]), (3, [math.nan, 1.0]), (4, [math.inf, 1.0]), (5, [0.0, 0.0]), (6, []), (7, [1.0]), (8, [3.0, 0.0]),
            (9, [1e-300, 0.0]), (10, [1e300, 1e290]), (None, [0.0, 5.0]), (None, [0.0, 6.0]), (11, [-0.0, -2.0]), (12, [-1.0, 0.0]),
            (12, [-1.0, 0.0]), (13, [1.0, 1.0, 1.0]), (None, None), (5, [1.0, 1.0, 1.0001])]
    assert got(spark, rows, "double") == brute(rows)
    assert got(spark, []) == []
    assert got(spark, [(3, None)]) == [(3, 0, 3, True)]
    assert got(spark, [(4, [1.0, 2.0])]) == [(4, 0, 4, True)]


def test_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(60):  # cosines within 1e-7 of the threshold, either side
        a = rng.normal(size=24)
        b = rng.normal(size=24)
        b -= a * (a @ b) / (a @ a)
        c = 0.9 + (i - 30) * 3e-9
        rows += [(2 * i, (a / np.linalg.norm(a)).tolist()), (2 * i + 1, (c * a / np.linalg.norm(a) + math.sqrt(1 - c * c) * b / np.linalg.norm(b)).tolist())]
    assert got(spark, rows, "double") == brute(rows)


def test_dense_blocks_and_forests():
    rng = np.random.default_rng(2)
    for share in (0.002, 0.05, 0.5, 1.0):
        near = rng.random((60, 80)) < share
        row, col = ed.forest(near)
        assert near[row, col].all()
        links = np.stack([row, col + 1000], 1)
        whole = np.stack(np.nonzero(near), 1) + [0, 1000]
        assert {tuple(x) for x in ed._tree(links)} == {tuple(x) for x in ed._tree(whole)}


def test_large_group_of_near_copies_is_counted_not_listed():
    rng = np.random.default_rng(3)
    units = ed.unit(rng.normal(size=30) + 0.01 * rng.normal(size=(3000, 30)))
    side = ed.Side(units, np.linalg.eigh(units.T @ units)[1][:, ::-1])
    weights = np.ones(3000, np.int64)
    ids = np.arange(3000)
    a, b, links = ed.tile_links(side, ids, weights, side, ids, weights, True, 0.9)
    assert (a == 2999).all() and (b == 2999).all() and len(links) == 2999


def test_tiles_far_apart_are_left():
    low = np.array([[0.0, 0.1], [0.5, 0.6], [0.05, 0.7], [np.nan, np.nan]])[:, None, :]
    assert ed.partners(low, 0, 0.99).tolist() == [0, 2]
    assert ed.partners(low, 0, 0.9).tolist() == [0, 1, 2]


def test_curve_steps_by_one_cell():
    import itertools
    for dims, bits in ((2, 3), (3, 2), (1, 4)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        at = hilbert_index(cells, bits)
        assert sorted(at) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(at)], axis=0)).sum(1) == 1).all()
    ties = block_of(np.full(1000, 5.0), np.array([5.0, 5.0, 9.0]), np.arange(1000))
    assert np.bincount(ties).tolist() == [334, 333, 333]
