import hashlib
import random
import re

import pytest

from tallyspark.llm import exact_dedup as D


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain(rows):
    groups = {}
    for key, text, _ in rows:
        groups.setdefault(norm(text), []).append(key)
    out, done = [], set()
    for key, text, _ in rows:
        ids = groups[norm(text)]
        keep = min((k for k in ids if k is not None), default=None)
        first = key == keep and norm(text) not in done
        if first:
            done.add(norm(text))
        out.append((key, keep, len(ids), first, hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(1, "a b", "x"), (2, "a\t\n b", "y"), (3, "a b", "z"), (None, "a b", "n"), (4, None, "x"), (5, "", "x"), (6, " ", "s"),
        (7, "\x0b\x0c", "s"), (8, "a b", "x"), (9, "A b", "x"), (3, "a b", "z"), (1, "a b", "x"), (None, "lone", "n"),
        (10, "long " * 300_000, "l"), (11, "long  " * 300_000, "l"), (12, "é", "x"), (12, "other", "x")]


def test_odd_rows(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, sha string").repartition(3)
    assert sorted((tuple(r) for r in D.exact_dedup(spark, df).collect()), key=str) == plain(ROWS)
    stay = D.drop_copies(spark, df)
    assert stay.columns == df.columns
    got = sorted((tuple(r)[0], norm(r.text)) for r in stay.collect() if r.doc_id is not None)
    want = sorted((k, norm(t)) for k, t, _ in set(ROWS) if k is not None and k == min(
        i for i, u, _ in ROWS if i is not None and norm(u) == norm(t)))
    assert got == want and stay.where("doc_id IS NULL").count() == 1
    assert D.exact_dedup(spark, df.limit(0)).count() == 0 and D.drop_copies(spark, df.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [1 << 20, 64])
def test_a_full_filter_changes_nothing(spark, bits, monkeypatch):
    monkeypatch.setattr(D, "filter_bits", lambda rows, most=0: bits)
    random.seed(bits)
    rows = [(i, f"text {random.randint(0, 400)}", "") for i in range(900)] + [(1000 + i, "hot", "") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted((tuple(r) for r in D.exact_dedup(spark, df).collect()), key=str) == plain(rows)


def test_unique_rows_pass_straight_through(spark):
    df = spark.range(5000).selectExpr("id AS key").selectExpr("cast(key AS string) AS sha")
    bits = D.filter_bits(5000)
    flagged = D.flag_repeated(df, "sha", D.repeated_cells(df, "sha", bits), bits, "again")
    assert flagged.count() == 5000 and flagged.where("again").count() < 50


def test_plan_has_no_python(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, sha string")
    plan = D.exact_dedup(spark, df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
