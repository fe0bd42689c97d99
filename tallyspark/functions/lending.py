"""Lending-language rules as Column expressions.

compliance lexicon scan (T5-T8), glossary check (T9/T10), loan-field extraction
(T11-T16), context completeness (T17) and heuristic confidence (T18).
Small dictionaries are unrolled into one expression per entry, which keeps the
whole scan inside generated code (higher-order functions would fall back to
interpreted evaluation).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from . import vocab as V
from .text import py_strip

ISSUE_TYPE = ("struct<category:string,phrase:string,severity:string,explanation:string,"
              "alternative:string>")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- compliance -------------------------------------------------------------

def compliance_hits(text, lexicon=None, low=None) -> list[tuple[Column, tuple]]:
    """(hit, lexicon row) per phrase; pass ``low`` (a lower-cased column) to reuse one lower()."""
    rows = lexicon if lexicon is not None else V.lexicon_rows()
    low = F.lower(_c(text)) if low is None else _c(low)
    return [(low.contains(F.lit(r[2].lower())), r) for r in rows]


def compliance_issues(text, lexicon=None, low=None) -> Column:
    """Ordered ARRAY<STRUCT> of issues: every phrase whose lower-case occurs in the lower-cased text."""
    items = []
    for hit, (_, category, phrase, severity, alternative) in compliance_hits(text, lexicon, low):
        items.append(F.when(hit, F.struct(
            F.lit(category).alias("category"), F.lit(phrase).alias("phrase"),
            F.lit(severity).alias("severity"),
            F.lit(V.ISSUE_EXPLANATION.format(category=category)).alias("explanation"),
            F.lit(alternative).alias("alternative"))))
    return F.array_compact(F.array(*items))


def safer_text(text, lexicon=None, low=None) -> Column:
    """For each detected phrase in order, case-sensitive literal replace; null when no issue."""
    acc = _c(text)
    any_hit = F.lit(False)
    for hit, (_, _cat, phrase, _sev, alternative) in compliance_hits(text, lexicon, low):
        # replacing a phrase with itself is a no-op, so one reference to acc per step
        acc = F.replace(acc, F.lit(phrase), F.when(hit, F.lit(alternative)).otherwise(F.lit(phrase)))
        any_hit = any_hit | hit
    return F.when(any_hit, acc)


def issue_categories(issues) -> Column:
    """Ordered categories (duplicates kept)."""
    return F.transform(_c(issues), lambda i: i["category"])


def safer_alternatives(issues) -> Column:
    return F.transform(_c(issues), lambda i: i["alternative"])


def is_safe(issues) -> Column:
    return F.size(_c(issues)) == 0


def routing_decision(issues) -> Column:
    """any high-severity issue blocks; other issues go to review; else pass."""
    iss = _c(issues)
    return (F.when(F.exists(iss, lambda i: i["severity"] == "high"), F.lit("block"))
             .when(F.size(iss) > 0, F.lit("review")).otherwise(F.lit("pass")))


# --- glossary ---------------------------------------------------------------

def _glossary_parts(text, entries, low=None):
    low = F.lower(_c(text)) if low is None else _c(low)
    used, warns = [], []
    for source, preferred in entries:
        s_hit = low.contains(F.lit(source.lower()))
        p_hit = low.contains(F.lit(preferred.lower()))
        used.append(F.when(s_hit | p_hit, F.lit(preferred)))
        warns.append(F.when(s_hit & ~p_hit, F.lit(V.GLOSSARY_WARNING.format(preferred=preferred, source=source))))
    terms_used = F.array_sort(F.array_distinct(F.array_compact(F.array(*used))))
    warnings = F.array_compact(F.array(*warns))
    return terms_used, warnings


def glossary_check(text, glossary_id=None, glossary_ids=tuple(V.GLOSSARY_FILES), low=None,
                   entries=None) -> tuple[Column, Column]:
    """(terms_used, warnings). ``glossary_id`` may be a literal or a Column;
    unknown, null or empty ids use the default glossary. ``entries``: a caller's own (term, preferred) list."""
    if entries is not None:
        return _glossary_parts(text, entries, low)
    if glossary_id is None or isinstance(glossary_id, str):
        return _glossary_parts(text, V.merged_glossary(glossary_id), low)
    gid = _c(glossary_id)
    t_def, w_def = _glossary_parts(text, V.merged_glossary(None), low)
    t_out, w_out = None, None
    for g in glossary_ids:
        t_g, w_g = _glossary_parts(text, V.merged_glossary(g), low)
        t_out = (F.when(gid == g, t_g) if t_out is None else t_out.when(gid == g, t_g))
        w_out = (F.when(gid == g, w_g) if w_out is None else w_out.when(gid == g, w_g))
    if t_out is None:
        return t_def, w_def
    return t_out.otherwise(t_def), w_out.otherwise(w_def)


def preferred_terms(glossary_id: str | None = None, entries=None) -> Column:
    """The merged glossary (or a caller's entries) as a MAP (constant per glossary)."""
    kv = []
    for k, v in (entries if entries is not None else V.merged_glossary(glossary_id)):
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


# --- extraction ---------------------------------------------------------------

def parse_number(num, unit) -> Column:
    """Digits and dots kept; multi-dot numbers are null; any unit word x 1,000,000."""
    cleaned = F.regexp_replace(_c(num), "(?U)[^\\d.]", "")
    value = cleaned.try_cast("double")
    mult = F.when(F.coalesce(F.length(_c(unit)), F.lit(0)) > 0, F.lit(1_000_000.0)).otherwise(F.lit(1.0))
    return F.when(F.length(cleaned) > 0, (value * mult).try_cast("bigint"))


# Each pattern scans a text once, for its whole first match; the groups are then taken from the match, which is
# short. A pattern without look-around finds the same groups in its own match as in the text.

def context_match(text) -> Column:
    return F.regexp_extract(_c(text), P.loan_context_java(), 0)


def term_match(text) -> Column:
    return F.regexp_extract(_c(text), P.term_java(), 0)


def income_match(text) -> Column:
    return F.regexp_extract(_c(text), P.income_java(), 0)


def money_matches(text, context=None) -> Column:
    """All money matches; with the context match given, only for texts that have none (others don't need them)."""
    found = F.regexp_extract_all(_c(text), F.lit(P.money_java()), F.lit(0))
    return found if context is None else F.when(_c(context) == "", found)


def loan_amount(text, context=None, money=None) -> Column:
    context = context_match(text) if context is None else _c(context)
    money = money_matches(text) if money is None else _c(money)
    ctx, pat = P.loan_context_java(), P.money_java()
    ctx_amount = parse_number(F.regexp_extract(context, ctx, 1), F.regexp_extract(context, ctx, 2))
    amounts = F.transform(money, lambda m: parse_number(F.regexp_extract(m, pat, 1), F.regexp_extract(m, pat, 2)))
    fallback = F.get(F.filter(amounts, lambda a: a >= 100_000), 0)
    return F.when(context != "", ctx_amount).otherwise(fallback)


def loan_term_months(text, match=None) -> Column:
    t = term_match(text) if match is None else _c(match)
    num = F.regexp_extract(t, P.term_java(), 1)
    unit = F.lower(F.regexp_extract(t, P.term_java(), 2))
    n = num.try_cast("bigint")
    return F.when(num != "", F.when(unit.isin(*P.YEAR_UNITS), F.try_multiply(n, F.lit(12).cast("bigint")))
                  .otherwise(n))


def monthly_income(text, match=None) -> Column:
    t = income_match(text) if match is None else _c(match)
    num = F.regexp_extract(t, P.income_java(), 1)
    return F.when(num != "", parse_number(num, F.regexp_extract(t, P.income_java(), 2)))


def find_term(text, terms, low=None) -> Column:
    low = F.lower(_c(text)) if low is None else _c(low)
    return F.coalesce(*[F.when(low.contains(F.lit(k.lower())), F.lit(v)) for k, v in terms])


def phone_number(text) -> Column:
    m = F.regexp_extract(_c(text), P.PHONE_JAVA, 0)
    return F.when(m != "", F.right(F.regexp_replace(m, "(?U)\\D", ""), F.lit(8)))


def with_extraction(df, text_col: str, out: str = "extraction"):
    """T11-T15 as one struct column (parsers see the unredacted text). Matches are columns of their own, so that Spark
    finds each once however often it is used."""
    t = F.col(text_col)
    df = df.withColumns({"_low": F.lower(t), "_ctx": context_match(t), "_term": term_match(t), "_inc": income_match(t)})
    df = df.withColumn("_money", money_matches(t, "_ctx"))
    return df.withColumn(out, extraction_struct(t, F.col("_low"), "_ctx", "_money", "_term", "_inc")).drop(
        "_low", "_ctx", "_money", "_term", "_inc")


def extraction_struct(text, low=None, context=None, money=None, term=None, income=None) -> Column:
    """T11-T15 as one struct (parsers see the unredacted text)."""
    return F.struct(
        loan_amount(text, context, money).alias("loan_amount"),
        loan_term_months(text, term).alias("loan_term_months"),
        monthly_income(text, income).alias("monthly_income"),
        find_term(text, V.EMPLOYMENT_TERMS, low).alias("employment_status"),
        find_term(text, V.COLLATERAL_TERMS, low).alias("collateral"),
        find_term(text, V.LOAN_TYPE_TERMS, low).alias("loan_type"),
        phone_number(text).alias("phone_number"),
    )


def missing_fields(extraction) -> Column:
    """Names of null fields in schema order (0 counts as present)."""
    e = _c(extraction)
    return F.array_compact(F.array(*[F.when(e[f].isNull(), F.lit(f)) for f in V.EXTRACTION_FIELDS]))


def context_missing_fields(context) -> Column:
    """Required fields absent from a MAP<STRING,STRING> context; falsy ('' or '0') is missing.

    Values of a JSON-decoded context arrive as strings here, so numeric 0 is '0'
    and boolean false is 'false'."""
    ctx = _c(context)

    def truthy(key):
        v = ctx.getItem(key)
        return F.coalesce(~v.isin("", "0", "0.0", "false", "[]", "{}"), F.lit(False))

    out = []
    for field in V.EXTRACTION_FIELDS:
        keys = V.CONTEXT_ALIASES.get(field, [field])
        present = F.lit(False)
        for k in keys:
            present = present | truthy(k)
        out.append(F.when(~present, F.lit(field)))
    return F.array_compact(F.array(*out))


# --- confidence / routing ---------------------------------------------------

def heuristic_confidence(text, n_warnings) -> Column:
    """0.88, -0.1 when the stripped text is shorter than 20, -min(0.25, 0.05*n); round 2; clamp."""
    n = F.coalesce(_c(n_warnings), F.lit(0))
    short = F.when(F.length(py_strip(text)) < V.CONFIDENCE_SHORT_LEN, F.lit(V.CONFIDENCE_SHORT_PENALTY)).otherwise(F.lit(0.0))
    warn = F.when(n > 0, F.least(F.lit(V.CONFIDENCE_WARNING_CAP), F.lit(V.CONFIDENCE_WARNING_STEP) * n)).otherwise(F.lit(0.0))
    score = F.round(F.lit(V.CONFIDENCE_BASE) - short - warn, 2)
    return F.greatest(F.lit(V.CONFIDENCE_MIN), F.least(F.lit(V.CONFIDENCE_MAX), score))


def review_routing(confidence, n_issues, require_review=False) -> tuple[Column, Column]:
    """(requires_human_review, reason)."""
    req = F.lit(bool(require_review)) if isinstance(require_review, bool) else _c(require_review)
    needs = req | (F.coalesce(_c(n_issues), F.lit(0)) > 0) | (_c(confidence) < V.REVIEW_THRESHOLD)
    return needs, F.when(needs, F.lit(V.REVIEW_REASON))
