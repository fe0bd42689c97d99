import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import fill_middle as fm


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = ["", None, " ", "a", "\n", "a\nb\r\n c\u0085d", "Öl für 😀😀 x", "<P>", "x<S>y", "<M", "<P" * 3, "S>M>P>", "a<<b>>S>", "$1 \\2 \\E \\Q $",
       "word " * 40, "9" * 50, "\x00a\x00b", "é ‍", "<", ">", "a" * 70_000 + " b", "-\n" * 60_000]


def test_equals_brute_force_and_restores(spark):
    rows = [(i * 31 + j, t, "x", "y") for j, t in enumerate(ODD) for i in range(25)] + [(None, "a b c", "x", "y"), (7, "same", "", ""), (7, "same", "", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, N string, output string").repartition(4)
    made = fm.fill_in_middle(df)
    assert made.columns == ["doc_id", "text", "N", "output", "_n", "form", "_output"]
    prefix, middle = fm.part_lengths(F.col("_output"), F.col("form"))
    back = made.select("doc_id", "text", "_n", "form", prefix, middle, "_output", fm.restored(F.col("_output"), F.col("form"))).collect()
    assert len(back) == len(rows)
    for doc_id, text, *found, again in back:
        assert tuple(found) == brute(doc_id, text)
        assert again == (text or "")
    assert {r[3] for r in back} == {"plain", "psm", "spm"}


def test_empty_table_other_units_and_sentinels(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert fm.fill_in_middle(df).collect() == []
    df = spark.createDataFrame([(i, "ab cd ef$ gh") for i in range(30)], "doc_id long, text string")
    made = fm.fill_in_middle(df, unit=r"\S+|\s+", sentinels=("$1", "[s]", "\\m"), cut_percent=100)
    got = made.select("n", "form", "output", fm.restored(F.col("output"), F.col("form"), ("$1", "[s]", "\\m")).alias("t")).collect()
    assert {r.t for r in got} == {"ab cd ef$ gh"} and {r.n for r in got} == {7} and all("$1" in r.output and "\\m" in r.output for r in got)
    for bad in (("<P>", "<P>", "<M>"), ("aba", "x", "y"), ("ab", "bc", "y"), ("", "x", "y"), ("abc", "b", "y")):
        with pytest.raises(ValueError):
            fm.fill_in_middle(df, sentinels=bad)


def test_plan_is_one_projection_without_python(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = fm.fill_in_middle(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
