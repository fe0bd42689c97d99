"""Corpus jobs over a ``(doc key, text, grouping columns)`` table.

Each job annotates rows with narrow Column expressions and, for reports, ends in a
``groupBy`` on a few low-cardinality keys (partial + final hash aggregate: the
shuffle carries one row per key per task, whatever the corpus size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scan
from ..functions import text as TX


def pii_flags(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Per-class PII flags, each pattern tested independently (order-free)."""
    t = F.col(text_col)
    return (df.withColumn("has_phone", TX.has_phone(t))
              .withColumn("has_email", TX.has_email(t))
              .withColumn("has_register", TX.has_register(t))
              .withColumn("has_long_number", TX.has_long_number(t)))


def pii_flags_by_source(df: DataFrame, keys=("source", "lang"), text_col: str = "text") -> DataFrame:
    """T2 report: documents carrying each PII class, by source and language."""
    flagged = pii_flags(df.select(*keys, text_col), text_col)
    return (flagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if("has_phone").alias("n_phone"),
        F.count_if("has_email").alias("n_email"),
        F.count_if("has_register").alias("n_register"),
        F.count_if("has_long_number").alias("n_long_number"),
        F.count_if(F.col("has_phone") | F.col("has_email") | F.col("has_register")
                   | F.col("has_long_number")).alias("n_any_pii")))


def redact(df: DataFrame, text_col: str = "text", out_col: str = "redacted_text",
           order: str = "reference") -> DataFrame:
    """Redacted copy of the text plus a changed flag."""
    return (df.withColumn(out_col, TX.redact_pii(F.col(text_col), order))
              .withColumn("redaction_changed", F.col(out_col) != F.col(text_col)))


def redaction_report(df: DataFrame, keys=("source",), text_col: str = "text") -> DataFrame:
    """T1 report: documents changed by redaction and token counts, by key."""
    red = redact(df.select(*keys, text_col), text_col)
    tokens = {
        "n_phone_tokens": "[REDACTED_PHONE]", "n_email_tokens": "[REDACTED_EMAIL]",
        "n_register_tokens": "[REDACTED_REGISTER]", "n_number_tokens": "[REDACTED_NUMBER]",
    }
    aggs = [F.count(F.lit(1)).alias("n_docs"), F.count_if("redaction_changed").alias("n_changed")]
    for name, tok in tokens.items():
        # occurrences = (len(text) - len(text without token)) / len(token)
        occ = (F.length("redacted_text") - F.length(F.replace(F.col("redacted_text"), F.lit(tok), F.lit("")))) / len(tok)
        aggs.append(F.sum(occ.cast("bigint")).alias(name))
    return red.groupBy(*keys).agg(*aggs)


def script_profile(df: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Cyrillic vs Latin counts, dominant language, mostly-English flags.

    Returns the confusion table (declared language x detected language).
    """
    per_doc = TX.with_script_counts(df.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("_t")),
                                    F.col("_t")).drop("_t").withColumn("detected", F.when(F.col("latin_chars") > F.col("mn_chars"), "en").otherwise("mn"))
    return per_doc.groupBy("lang", "detected").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("mn_chars").alias("mn_chars"),
        F.sum("latin_chars").alias("latin_chars"),
        F.count_if(F.col("latin_chars") > F.col("mn_chars") * 0.35).alias("n_mostly_en_v2"),
        F.count_if(F.col("latin_chars") > F.col("mn_chars") * 0.25).alias("n_mostly_en_v3"),
    )


def clean_and_gate(df: DataFrame, text_col: str = "text", threshold: float = 0.6) -> DataFrame:
    """whitespace-normalised text, Mongolian share and keep flag."""
    cleaned = df.withColumn("clean_text", TX.collapse_ws(F.col(text_col)))
    chars = cleaned.withColumn("_share_chars", scan.share_chars(F.col("clean_text")))
    return (chars.withColumn("mn_share", F.col("_share_chars") / F.greatest(F.length("clean_text"), F.lit(1))).drop("_share_chars")
                   .withColumn("keep", (F.length("clean_text") > 0) & (F.col("mn_share") > F.lit(threshold))))


def mongolian_filter(df: DataFrame, text_col: str = "text", threshold: float = 0.6) -> DataFrame:
    """F6 as the reference job: keep Mongolian-looking rows with the cleaned text."""
    gated = clean_and_gate(df, text_col, threshold)
    return (gated.filter("keep").withColumn(text_col, F.col("clean_text"))
                 .drop("clean_text", "mn_share", "keep"))


def clean_text_share(df: DataFrame, keys=("lang",), text_col: str = "text", threshold: float = 0.6) -> DataFrame:
    """F6 report: share histogram (deciles) and kept rows per key."""
    gated = clean_and_gate(df.select(*keys, text_col), text_col, threshold)
    return (gated.withColumn("share_decile", F.floor(F.col("mn_share") * 10).cast("bigint"))
                 .groupBy(*keys, "share_decile")
                 .agg(F.count(F.lit(1)).alias("n_docs"), F.count_if("keep").alias("n_kept")))


def reasoning_report(df: DataFrame, keys=("source",), text_col: str = "text") -> DataFrame:
    """Texts with reasoning tags and how much stripping removes."""
    return (df.select(*keys, F.col(text_col).alias("_t"))
              .withColumn("_s", TX.strip_reasoning(F.col("_t")))
              .groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("n_docs"),
                   F.count_if(TX.has_reasoning_tag(F.col("_t"))).alias("n_tag_substring"),
                   F.count_if(TX.has_think_tag_regex(F.col("_t"))).alias("n_tag_regex"),
                   F.count_if(TX.has_reasoning_tag(F.col("_s"))).alias("n_tag_after_strip"),
                   F.sum(F.length("_t") - F.length("_s")).alias("chars_removed")))
