import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import hard_negatives as hn


def brute(rows, every=100, k=5, low=80):
    """By all scores in Python's integers: rows are (id, vector, label)."""
    ok = [r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [(i, [math.floor(256 * x) for x in v], g) for i, v, g in ok]
    out = []
    for ai, a, g in whole:
        if ai % every:
            continue
        score = [(-sum(x * y for x, y in zip(a, v, strict=False)), i, h) for i, v, h in whole if i != ai]
        for p, pi, _ in sorted(x for x in score if x[2] == g)[:k]:
            hits = sorted(x for x in score if x[2] != g and low * -p <= 100 * -x[0] <= 100 * -p)[:k]
            out += [(ai, pi, r + 1, ni, -p, -n) for r, (n, ni, _) in enumerate(hits)]
    return sorted(out)


def got(spark, rows, kind="float", **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows], f"vec_id long, embedding array<{kind}>, label int, score string").repartition(3)
    return sorted(tuple(r) for r in hn.mine(spark, df, F.col("label"), **kw).collect())


def vectors(rng, n, width, spread=1.0):
    decay = np.exp(-spread * np.arange(width) / 4)
    return [[float(np.float32(x)) for x in rng.normal(size=width) * decay] for _ in range(n)]


@pytest.mark.parametrize("block,part,chunk", [(4096, 16_384, 1024), (40, 16_384, 1024), (100, 30, 3)])
def test_equals_brute_force(spark, monkeypatch, block, part, chunk):
    monkeypatch.setattr(hn, "PART", part)
    monkeypatch.setattr(hn, "CHUNK", chunk)
    if part == 30:
        monkeypatch.setattr(hn, "MOST_BLOCKS", 4)
    rng = np.random.default_rng(block)
    rows = [(int(i) * 5, v, int(g)) for i, v, g in zip(rng.permutation(600), vectors(rng, 600, 12), rng.integers(0, 4, 600), strict=True)]
    rows += [(9000 + i, rows[0][1], i % 3) for i in range(40)]  # a hot vector with several labels: ties
    want = brute(rows)
    assert got(spark, rows, block=block) == want
    assert len(want) > 200 and len({r[2] for r in want}) == 5


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0], 1), (100, [2.0, 1.0], 2), (1, [1.0, 2.0], 1), (2, [0.9, 2.0], 2), (2, [0.9, 2.0], 1), (3, [1.0, 1.9], 2),
            (4, None, 1), (5, [1.0, None], 1), (6, [math.nan, 1.0], 2), (7, [math.inf, 1.0], 1), (8, [9.0, 9.0], None), (None, [1.0, 2.0], 2),
            (200, [], 1), (9, [1.0], 2), (300, [-1.0, -2.0], 1), (10, [-3.0, -3.0], 3), (400, [0.0, 0.0], 7), (11, [0.0, 0.0], 7), (12, [0.0, 0.0], 8)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0], 1)]) == []
    assert got(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == []
    assert got(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)]) == [(0, 1, 1, 2, 256 * 256, 256 * 230)]


def test_large_components_are_exact(spark):
    rows = [(0, [2.0 ** 20, 3.0], 1), (1, [2.0 ** 21, 1.0], 1), (2, [2.0 ** 20 * 1.9, 7.0], 2), (3, [2.0 ** 20 * 1.9, 7.00390625], 2)]
    assert got(spark, rows, "double") == brute(rows)
    with pytest.raises(Exception, match="range of a long"):
        got(spark, [(0, [2.0 ** 40], 1), (1, [2.0 ** 40], 1)], "double")
    with pytest.raises(Exception, match="range of a long"):
        got(spark, [(0, [1e300], 1)], "double")


def test_bounds_hold_and_leave_blocks():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16)) * 600
    blocks = [np.floor(c + rng.normal(size=(50, 16)) * 40) for c in centres]
    axes, _ = np.linalg.qr(rng.normal(size=(16, 16)))
    turned = [b @ axes for b in blocks]
    zones = hn.Zones(np.array([t.min(0) for t in turned]), np.array([t.max(0) for t in turned]),
                     np.array([np.sqrt((t[:, 6:] ** 2).sum(1)).max() for t in turned]), 6)
    anchors = np.concatenate([b[:3] for b in blocks])
    low, high = zones.bounds(anchors @ axes)
    left = 0
    for j, b in enumerate(blocks):
        true = anchors @ b.T
        assert (true.min(1) >= low[:, j]).all() and (true.max(1) <= high[:, j]).all()
    for i in range(len(anchors)):
        own = np.sort(anchors[i] @ blocks[i // 3].T)[-6]
        left += (high[i] < own).sum()
    assert left > 0.5 * high.size
