import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tallyspark.llm import simhash
from tallyspark.llm.components import components


def plain_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """Brute force over all pairs of (id, fingerprint)."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= 3:
                root[find(i)] = find(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(key)
    return [min((k for k in groups[find(i)] if k is not None), default=None) for i in range(len(rows))]


def test_fingerprints_and_components_of_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in df.collect()]
    want = {k: (f"{fp:016x}", c) for (k, fp), c in zip(rows, plain_components(rows))}
    got = simhash.near_duplicates(spark, df).collect()
    assert len(got) == len(want) and all((r.fingerprint, r.component_id) == want[r.doc_id] for r in got)
    assert sum(k != c for k, (_, c) in want.items()) > 50


def odd_rows():
    text = "alpha beta gamma delta epsilon zeta eta theta"
    return [(1, text, "x"), (2, text, "y"), (None, text.upper(), "z"), (3, None, "x"), (4, "", "y"), (5, " \t\n", "z"),
            (6, "one", "q"), (6, "one", "q"), (7, "é\x85b c d", "q"), (None, "unique words stand here alone", "n"),
            (9, "word " * 200_000, "long"), (6, "another text of the same id", "r")]


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, root string, fp int")
    want = sorted(((k, f"{plain_fingerprint(t):016x}", c) for (k, t, _), c in zip(
        rows, plain_components([(k, plain_fingerprint(t)) for k, t, _ in rows]))), key=str)
    assert sorted((tuple(r) for r in simhash.near_duplicates(spark, df).collect()), key=str) == want
    stay = simhash.drop_near_copies(spark, df)
    assert stay.columns == df.columns
    assert sorted(((r.doc_id, r.root) for r in stay.collect()), key=str) == sorted(
        [(1, "x"), (3, "x"), (6, "q"), (7, "q"), (None, "n"), (9, "long"), (6, "r")], key=str)
    assert simhash.near_duplicates(spark, df.limit(0)).count() == 0
    assert simhash.drop_near_copies(spark, df.limit(0)).count() == 0


@pytest.mark.parametrize("dense", [8, 1024])
def test_dense_sets_keep_every_link(dense):
    random.seed(dense)
    base = [random.getrandbits(64) for _ in range(5)]
    found = {b ^ sum(1 << i for i in random.sample(range(32), random.randint(0, 5))) for b in base for _ in range(60)}
    found = np.array(sorted(found), np.uint64)
    links = simhash.close_links(found, list(range(32)), dense=dense)
    assert len(links) < len(found)
    label = {int(f): int(f) for f in found}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for a, b in links.tolist():
        label[find(a)] = find(b)
    low = [int(f) & 0xFFFFFFFF for f in found]
    for i in range(len(found)):
        for j in range(i):
            if bin(int(found[i]) ^ int(found[j])).count("1") <= 3:
                assert find(int(found[i])) == find(int(found[j])), (low[i], low[j])


def test_blocks_meet_for_every_close_pair():
    masks = simhash.block_masks()
    random.seed(1)
    for _ in range(2000):
        a = random.getrandbits(64)
        b = a ^ sum(1 << i for i in random.sample(range(64), 3))
        assert any(a & m == b & m for m in masks)


def test_runs_over_small_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        base = 0x0123456789ABCDEF
        df = spark.createDataFrame([(base ^ (1 << i),) for i in range(40)] + [(base ^ (1 << 60),)], "fp long")
        roots = components(spark, simhash.near_links(df)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(roots) == 41 and len({r.root for r in roots}) == 1


def test_components_of_a_chain(spark):
    n = 300
    random.seed(4)
    ids = random.sample(range(10_000), n)
    links = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")
    got = components(spark, links).collect()
    assert len(got) == n and {r.root for r in got} == {min(ids)}


def test_heavy_keys_are_split_before_they_meet(spark):
    rng = np.random.default_rng(11)
    base = np.uint64(0x0123456789ABCDEF)
    near = base ^ rng.integers(0, 1 << 14, 3000).astype(np.uint64)  # all keys that cover none of these bits are one
    far = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    fps = np.unique(np.concatenate([near, far])).view(np.int64)
    df = spark.createDataFrame([(int(x),) for x in fps], "fp long").repartition(4)
    keyed = simhash.keyed_blocks(spark, df, heavy=100)
    assert keyed.groupBy("mask", "key").count().agg({"count": "max"}).first()[0] <= 100
    links = np.array(simhash.near_links(df, heavy=100).collect(), np.int64).view(np.uint64)
    want = simhash.close_links(fps.view(np.uint64), list(range(64)), dense=1 << 30)
    label = lambda x: {int(a): int(b) for a, b in simhash._tree(x)}
    assert label(links) == label(want) and len(label(links)) > 1000
