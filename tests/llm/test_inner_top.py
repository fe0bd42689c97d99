import math
import random

import numpy as np
import pytest

from tallyspark.llm import inner_top


def brute(rows, k=5, every=50):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in ok]
    out = []
    for qi, q in whole:
        if qi % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), ci) for ci, c in whole if ci != qi)[:k]
            out += [(qi, r + 1, ci, -s) for r, (s, ci) in enumerate(scores)]
    return sorted(out)


def got(spark, rows, kind="float", **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows], f"vec_id long, embedding array<{kind}>, score string")
    return sorted(tuple(r) for r in inner_top.top_inner(spark, df, **kw).collect())


def test_odd_vectors_ties_and_hot_vector(spark):
    random.seed(3)
    draw = lambda n: [float(np.float32(random.gauss(0, 1))) for _ in range(n)]
    rows = [(i, draw(8)) for i in range(300)] + [(1000 + i, [1.5] * 8) for i in range(200)]
    rows += [(2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 8), (2150, [float("inf")] * 8), (2200, [0.0] * 8),
             (2250, []), (2300, [0.25, 0.5]), (None, [9.0] * 8), (2350, [-3.0] * 8)]
    assert got(spark, rows) == brute(rows)


def test_few_rows_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (50, [2.0, 1.0]), (7, [0.5, 0.5])]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


@pytest.mark.parametrize("head", [1, 40])
def test_blocks_and_shares(spark, monkeypatch, head):
    monkeypatch.setattr(inner_top, "QUERY_BLOCK", 7)
    monkeypatch.setattr(inner_top, "CHUNK", 60)
    random.seed(5)
    rows = [(i, [float(np.float32(random.gauss(0, 1) * (1 + i % 7))) for _ in range(20)]) for i in range(400)]
    assert got(spark, rows, every=10, head=head) == brute(rows, every=10)


def test_pruning_keeps_results_and_saves_products():
    rng = np.random.default_rng(1)
    c = np.floor(rng.normal(size=(5000, 32)) * (256 * rng.exponential(size=(5000, 1)))) * np.r_[np.full(8, 4), np.ones(24)]
    q = c[:50]
    turn = np.linalg.eigh(c.T @ c)[1][:, ::-1]
    row, ids, score = inner_top.search_block(q, np.arange(50), np.full(50, -np.inf), c, np.arange(5000), turn, tile=256)
    full = q @ c.T
    full[np.arange(50), np.arange(50)] = -np.inf
    for r in range(50):
        want = np.lexsort((np.arange(5000), -full[r]))[:5]
        assert ids[row == r].tolist() == want.tolist() and score[row == r].tolist() == full[r][want].tolist()


@pytest.mark.parametrize("power", [13, 21, 30])
def test_large_components_are_exact(spark, power):
    rnd = random.Random(power)
    rows = [(i, [rnd.gauss(0, 1) * 2.0 ** rnd.choice([power, power - 1, 3]) for _ in range(128 if power < 30 else 12)]) for i in range(0, 150, 5)]
    rows += [(0 + 5 * 100, [2.0 ** (power - 8)] * 4), (5 * 101, [2.0 ** (power - 8)] * 4)]
    if power == 30:  # products near the end of a long's range
        rows = [(i, [x / 2 ** 9 for x in v]) for i, v in rows]
    assert got(spark, rows, "double", head=7) == brute(rows)


def test_the_case_of_clamped_components(spark):
    rows = [(0, [2.0 ** 21, 0.0]), (1, [2.0 ** 22, 1.0]), (2, [2.0 ** 21, 9.0]), (3, [1.0, 1.0])]
    assert got(spark, rows, "double") == brute(rows)
    assert got(spark, rows, "double")[0] == (0, 1, 1, 576460752303423488)


def test_beyond_a_long_is_an_error(spark):
    for rows in ([(0, [2.0 ** 40]), (1, [2.0 ** 40])], [(0, [1e300])]):
        with pytest.raises(Exception, match="range of a long|too large|out of bounds|OverflowError"):
            got(spark, rows, "double")
