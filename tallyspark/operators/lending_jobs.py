"""Corpus jobs built from the lending-language rules.

Each job annotates a table of texts and, where useful, reports per group. Small
dictionaries are unrolled into the projection (no join, no shuffle); a caller
lexicon larger than ``UNROLL_MAX`` phrases, of any size, is matched through a rare-gram index, with
the same columns as a result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lending as L
from ..functions import text as TX
from ..functions import vocab as V
from .lexicon_index import phrase_hits

UNROLL_MAX = 256


def compliance_scan(df: DataFrame, text_col: str = "text", lexicon=None, sensitive=True) -> DataFrame:
    """Issues, safer text, categories, alternatives, verdict, routing decision."""
    t = F.col(text_col)
    df = df.withColumn("_low", F.lower(t))  # one lower() per row, shared by every phrase test
    low = F.col("_low")
    if sensitive is True:
        issues = L.compliance_issues(t, lexicon, low)
        safer = L.safer_text(t, lexicon, low)
    else:  # per-row flag: only compliance-sensitive rows are scanned
        flag = F.coalesce(F.col(sensitive), F.lit(False)) if isinstance(sensitive, str) else F.lit(False)
        issues = F.when(flag, L.compliance_issues(t, lexicon, low)).otherwise(F.array().cast(f"array<{L.ISSUE_TYPE}>"))
        safer = F.when(flag, L.safer_text(t, lexicon, low))
    return (df.withColumn("issues", issues)
              .withColumn("safer_text", safer).drop("_low")
              .withColumn("compliance_warnings", L.issue_categories("issues"))
              .withColumn("safer_alternatives", L.safer_alternatives("issues"))
              .withColumn("is_safe", L.is_safe("issues"))
              .withColumn("decision", L.routing_decision("issues")))


def compliance_scan_table(df: DataFrame, text_col: str, lexicon_df: DataFrame, unroll_max: int = UNROLL_MAX) -> DataFrame:
    """T5-T8 and F10 for a caller-supplied lexicon table (ord, category, phrase, severity, alternative).

    Up to ``unroll_max`` phrases are collected (a bounded number) and unrolled into the projection. A longer lexicon goes through the
    rare-gram index of :mod:`lexicon_index`: the same columns, and no text in a join or an exchange."""
    lex = lexicon_df.select("ord", "category", "phrase", "severity", "alternative")
    if unroll_max > 0:
        rows = lex.orderBy("ord").limit(unroll_max + 1).collect()
        if len(rows) <= unroll_max:
            return compliance_scan(df, text_col, [tuple(r) for r in rows])
    lowered = df.withColumn("_low", F.lower(F.col(text_col)))
    found = lowered.withColumn("_hits", phrase_hits(lowered, "_low", lex)).drop("_low")
    issues = F.transform("_hits", lambda h: F.struct(
        h["category"].alias("category"), h["phrase"].alias("phrase"), h["severity"].alias("severity"),
        F.concat(F.lit("Detected risky lending wording: "), h["category"], F.lit(".")).alias("explanation"),
        h["alternative"].alias("alternative")))
    safer = F.when(F.size("issues") > 0, F.aggregate("issues", F.col(text_col), lambda t, i: F.replace(t, i["phrase"], i["alternative"])))
    return (found.withColumn("issues", issues).drop("_hits")
              .withColumn("safer_text", safer)
              .withColumn("compliance_warnings", L.issue_categories("issues"))
              .withColumn("safer_alternatives", L.safer_alternatives("issues"))
              .withColumn("is_safe", L.is_safe("issues"))
              .withColumn("decision", L.routing_decision("issues")))


def compliance_report(scanned: DataFrame, keys=("domain",)) -> DataFrame:
    """T5 report: issue counts by category and severity per key."""
    return (scanned.select(*keys, F.explode("issues").alias("i"))
                   .groupBy(*keys, F.col("i.category").alias("category"), F.col("i.severity").alias("severity"))
                   .agg(F.count(F.lit(1)).alias("n_issues")))


def glossary_job(df: DataFrame, text_col: str = "text", glossary_id=None, entries=None) -> DataFrame:
    """Terms used (sorted, distinct) and warnings (glossary order); ``entries`` is a caller's (term, preferred) list."""
    df = df.withColumn("_low", F.lower(F.col(text_col)))
    terms, warns = L.glossary_check(F.col(text_col), glossary_id, low=F.col("_low"), entries=entries)
    return df.withColumn("terms_used", terms).withColumn("glossary_warnings", warns).drop("_low")


def glossary_overlay(file_df: DataFrame, default_terms=None) -> DataFrame:
    """S6 for glossary files stored as a table (glossary_id, ord, term, preferred).

    Per glossary: the default terms first, in default order, with the file's value when it has one; then the
    file's new terms in file order. A full outer join on (glossary_id, term): no glossary is gathered in one row."""
    defaults = default_terms if default_terms is not None else V.DEFAULT_GLOSSARY
    entry = [F.struct(F.lit(i).cast("bigint").alias("d_ord"), F.lit(t).alias("term"), F.lit(p).alias("d_preferred"))
             for i, (t, p) in enumerate(defaults)]
    base = file_df.select("glossary_id").distinct().select("glossary_id", F.inline(F.array(*entry)))
    joined = base.join(file_df.select("glossary_id", "term", F.col("ord").cast("bigint").alias("f_ord"), "preferred"),
                       ["glossary_id", "term"], "full_outer")
    return joined.select("glossary_id", F.coalesce("d_ord", F.col("f_ord") + F.lit(len(defaults))).alias("ord"), "term",
                         F.coalesce("preferred", "d_preferred").alias("preferred"))


#: Dictionary entries up to which glossaries are broadcast; beyond that texts and glossaries meet by a salted join.
BROADCAST_ENTRIES = 200_000
GLOSSARY_SALTS = 16


def glossary_by_row(df: DataFrame, text_col: str, glossary_table: DataFrame, id_col: str = "glossary_id", default_terms=None,
                    broadcast_entries: int = BROADCAST_ENTRIES) -> DataFrame:
    """T9/S6 with a glossary for each row: ``terms_used`` and ``glossary_warnings`` by the dictionary that ``id_col`` names.

    ``glossary_table`` (glossary_id, ord, term, preferred) holds any number of dictionaries, each laid over the default terms; null
    and unknown ids take the defaults alone. A dictionary is one array (it is one file's entries). Dictionaries are broadcast behind a
    count of their entries; beyond it rows of one id are dealt over ``GLOSSARY_SALTS`` copies of its dictionary."""
    defaults = default_terms if default_terms is not None else V.DEFAULT_GLOSSARY
    entry = F.struct("ord", "term", "preferred")
    per = glossary_overlay(glossary_table, defaults).groupBy(F.col("glossary_id").alias("_gid")).agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["term"].alias("term"), e["preferred"].alias("preferred"))).alias("_entries"))
    size = per.agg(F.sum(F.size("_entries"))).first()[0] or 0
    if size <= broadcast_entries:
        joined = df.join(F.broadcast(per), F.col(id_col) == F.col("_gid"), "left")
    else:
        salt = F.pmod(F.xxhash64(text_col, F.monotonically_increasing_id()), F.lit(GLOSSARY_SALTS)).cast("int")
        copies = per.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(GLOSSARY_SALTS - 1))))
        joined = df.withColumn("_salt", salt).join(copies, (F.col(id_col) == F.col("_gid")) & (F.col("_salt") == F.col("_copy")), "left").drop("_salt", "_copy")
    base = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(p).alias("preferred")) for t, p in defaults])
    joined = joined.withColumn("_entries", F.coalesce("_entries", base)).withColumn("_low", F.lower(F.col(text_col)))
    low = F.coalesce("_low", F.lit(""))
    source = lambda e: F.contains(low, F.lower(e["term"]))
    preferred = lambda e: F.contains(low, F.lower(e["preferred"]))
    before, after = V.GLOSSARY_WARNING.split("{preferred}")
    middle, end = after.split("{source}")
    message = lambda e: F.concat(F.lit(before), e["preferred"], F.lit(middle), e["term"], F.lit(end))
    used = F.array_sort(F.array_distinct(F.transform(F.filter("_entries", lambda e: source(e) | preferred(e)), lambda e: e["preferred"])))
    warned = F.transform(F.filter("_entries", lambda e: source(e) & ~preferred(e)), message)
    return joined.withColumn("terms_used", used).withColumn("glossary_warnings", warned).drop("_entries", "_low", "_gid")


def extraction_job(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Fields (from the unredacted text), missing fields, redacted text, confidence."""
    t = F.col(text_col)
    out = L.with_extraction(df, text_col)
    out = out.withColumn("missing_fields", L.missing_fields("extraction"))
    out = out.withColumn("redacted_text", TX.redact_pii(t))
    out = out.withColumn("confidence", L.heuristic_confidence(F.col("redacted_text"), F.size("missing_fields")))
    return out.select("*", "extraction.*").drop("extraction")


def completeness_report(extracted: DataFrame, keys=("source",)) -> DataFrame:
    """T16 report: share of rows with each field present, per key."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for f in V.EXTRACTION_FIELDS:
        aggs.append(F.count(F.col(f)).alias(f"n_{f}"))
    aggs.append(F.count_if(F.size("missing_fields") == 0).alias("n_complete"))
    return extracted.groupBy(*keys).agg(*aggs)


def review_job(df: DataFrame, output_col: str, source_text_col: str, glossary_id=None,
               compliance_sensitive=False, require_review=False, lexicon=None, entries=None) -> DataFrame:
    """Translation review routing (glossary warnings + issues feed the confidence).

    Defaults follow the translation request: not compliance-sensitive, no forced review."""
    df = df.withColumn("_low", F.lower(F.col(source_text_col)))
    terms, warns = L.glossary_check(F.col(source_text_col), glossary_id, low=F.col("_low"), entries=entries)
    issues = (L.compliance_issues(F.col(source_text_col), lexicon, F.col("_low")) if compliance_sensitive
              else F.array().cast(f"array<{L.ISSUE_TYPE}>"))
    out = (df.withColumn("terms_used", terms).withColumn("glossary_warnings", warns)
             .withColumn("_n_issues", F.size(issues)).drop("_low"))
    conf = L.heuristic_confidence(F.col(output_col), F.size("glossary_warnings") + F.col("_n_issues"))
    out = out.withColumn("confidence", conf)
    needs, reason = L.review_routing(F.col("confidence"), F.col("_n_issues"), require_review)
    return out.withColumn("requires_human_review", needs).withColumn("reason", reason).drop("_n_issues")


def rewrite_audit(df: DataFrame, text_col: str, rewritten_col: str, glossary_id=None, lexicon=None, entries=None,
                  compliance_sensitive=True) -> DataFrame:
    """warnings = glossary warnings + issue categories; confidence over the rewritten text. Texts that
    aren't compliance-sensitive are not scanned (``compliance_sensitive``: a boolean or a boolean column's name)."""
    t = F.col(text_col)
    _terms, warns = L.glossary_check(t, glossary_id, entries=entries)
    none = F.array().cast(f"array<{L.ISSUE_TYPE}>")
    found = L.compliance_issues(t, lexicon)
    flag = F.col(compliance_sensitive) if isinstance(compliance_sensitive, str) else F.lit(bool(compliance_sensitive))
    issues = found if compliance_sensitive is True else F.when(F.coalesce(flag, F.lit(False)), found).otherwise(none)
    out = (df.withColumn("compliance_warnings", L.issue_categories(issues))
             .withColumn("safer_alternatives", L.safer_alternatives(issues))
             .withColumn("_warnings", F.concat(warns, F.col("compliance_warnings"))))
    return (out.withColumn("confidence", L.heuristic_confidence(F.col(rewritten_col), F.size("_warnings")))
               .drop("_warnings"))
