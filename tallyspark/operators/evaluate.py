"""Benchmark scoring and evaluation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX

# ---------------------------------------------------------------------------
# FIXED VALUES — placeholder scores, notes, default judge, required categories.
SCORE_EMPTY, SCORE_SHORT, SCORE_PRESENT = 0.5, 0.65, 0.8
SHORT_LEN = 10
OFFLINE_NOTE = "Heuristic placeholder; replace with Qwen teacher judge."
SERVICE_NOTE = "Placeholder heuristic score. Use teacher/evaluator model for production grading."
DEFAULT_JUDGE = "Qwen3-235B-A22B-Instruct-2507"
REQUIRED_CATEGORIES = ["compliance_rewrite", "borrower_chat", "loan_extraction", "translation_en_mn",
                       "translation_mn_en", "glossary_enforcement"]
# ---------------------------------------------------------------------------


def offline_score(expected) -> F.Column:
    """A2: '' or null -> 0.5; stripped length < 10 -> 0.65; else 0.8."""
    e = F.col(expected) if isinstance(expected, str) else expected
    return (F.when(F.coalesce(F.length(e), F.lit(0)) == 0, F.lit(SCORE_EMPTY))
             .when(F.length(TX.py_strip(e)) < SHORT_LEN, F.lit(SCORE_SHORT)).otherwise(F.lit(SCORE_PRESENT)))


def service_score(expected) -> F.Column:
    """A3: non-blank after strip -> 0.8, else 0.5."""
    e = F.col(expected) if isinstance(expected, str) else expected
    return F.when(TX.is_blank(e), F.lit(SCORE_EMPTY)).otherwise(F.lit(SCORE_PRESENT))


def average(score_col: str = "score") -> F.Column:
    """A4: mean rounded to 3 decimals; 0.0 for an empty set."""
    return F.coalesce(F.round(F.avg(score_col), 3), F.lit(0.0))


def score_items(items: DataFrame, id_col: str, expected_col: str, mode: str = "offline") -> DataFrame:
    fn, note = (offline_score, OFFLINE_NOTE) if mode == "offline" else (service_score, SERVICE_NOTE)
    return items.select(F.col(id_col).alias("item_id"), fn(expected_col).alias("score"), F.lit(note).alias("notes"))


def summary(scores: DataFrame, keys=(), judge: str | None = None) -> DataFrame:
    """A5 header per benchmark/key: item count, rounded and unrounded mean, judge."""
    g = scores.groupBy(*keys) if keys else scores.groupBy()
    return g.agg(F.count(F.lit(1)).alias("n_items"), average().alias("average_score"),
                 F.avg("score").alias("mean_score_raw")).withColumn("judge_model", F.lit(judge or DEFAULT_JUDGE))


def regression(candidate: DataFrame, production: DataFrame, keys=("item_id",)) -> DataFrame:
    """Equi-join two score tables; per-item delta and regression flag."""
    c = candidate.select(*keys, F.col("score").alias("candidate_score"))
    p = production.select(*keys, F.col("score").alias("production_score"))
    j = c.join(p, list(keys), "full_outer")
    return (j.withColumn("delta", F.col("candidate_score") - F.col("production_score"))
             .withColumn("regressed", F.coalesce(F.col("delta") < 0, F.lit(False))))


def category_coverage(items: DataFrame, task_col: str = "task", required=REQUIRED_CATEGORIES) -> DataFrame:
    """Required categories with their item counts (0 = missing)."""
    spark = items.sparkSession
    req = spark.createDataFrame([(c,) for c in required], "task string")
    counts = items.groupBy(F.col(task_col).alias("task")).agg(F.count(F.lit(1)).alias("n_items"))
    return req.join(counts, "task", "left").select("task", F.coalesce("n_items", F.lit(0)).alias("n_items"))
