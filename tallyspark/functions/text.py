"""Text Column builders: whitespace, script counts, PII, reasoning tags.

All functions take and return ``Column``s and stay inside whole-stage codegen
(regular expressions are literal, so each task compiles them once).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(_c(col), f"\\A[{P.WS}]+|[{P.WS}]+\\z", "")


def collapse_ws(col) -> Column:
    """Collapse every whitespace run to one space, then strip (clean_text)."""
    return F.trim(F.regexp_replace(_c(col), f"[{P.WS}]+", " "))


def is_blank(col) -> Column:
    """True when null, empty, or whitespace only. The search ends at the first other character, however long the text is."""
    return F.coalesce(~_c(col).rlike(f"[^{P.WS}]"), F.lit(True))


def count_class(col, char_class: str) -> Column:
    """Number of characters of ``col`` that fall in the regex class ``[char_class]``."""
    return F.length(F.regexp_replace(_c(col), f"[^{char_class}]", ""))


def count_chars(col, chars: str) -> Column:
    """Number of characters of ``col`` that are in ``chars`` (code-point translate, no regex)."""
    c = _c(col)
    return F.length(c) - F.length(F.translate(c, chars, ""))


def mongolian_count(col) -> Column:
    return count_chars(col, P.MN_LETTER_CHARS)


def latin_count(col) -> Column:
    return count_chars(col, P.LATIN_CHARS)


def script_counts(col) -> tuple[Column, Column]:
    """(Mongolian letters, Latin letters) with one full pass: Latin letters are counted
    on the string that is left once the Mongolian letters are removed."""
    c = _c(col)
    rest = F.translate(c, P.MN_LETTER_CHARS, "")
    return F.length(c) - F.length(rest), F.length(rest) - F.length(F.translate(rest, P.LATIN_CHARS, ""))


def with_script_counts(df, col, mn_name: str = "mn_chars", latin_name: str = "latin_chars"):
    """``script_counts`` as columns, counted an Arrow batch at a time."""
    from . import scan
    out = df.withColumn("_letters", scan.letters(_c(col)))
    return (out.withColumn(mn_name, F.col("_letters.mn").cast("int")).withColumn(latin_name, F.col("_letters.latin").cast("int"))
               .drop("_letters"))


def dominant_language(col) -> Column:
    """'en' when Latin letters outnumber Cyrillic ones, else 'mn' (ties and empty too)."""
    return F.when(latin_count(col) > mongolian_count(col), F.lit("en")).otherwise(F.lit("mn"))


def mostly_english(col, k: float) -> Column:
    """Latin letters > k * Mongolian letters (k=0.35 for v2 gates, 0.25 for v3)."""
    return latin_count(col) > mongolian_count(col) * F.lit(k)


# --- PII -------------------------------------------------------------------

def has_phone(col) -> Column:
    return _c(col).rlike(P.PHONE_JAVA)


def has_email(col) -> Column:
    c = _c(col)
    # an e-mail needs an '@': the plain substring test skips the regex for most texts
    return F.when(c.contains("@"), c.rlike(P.EMAIL_JAVA)).otherwise(F.lit(False))


def has_register(col) -> Column:
    return _c(col).rlike(P.REGISTER_JAVA)


def has_long_number(col) -> Column:
    return _c(col).rlike(P.LONG_NUMBER_JAVA)


def redact_pii(col, order: str = "reference") -> Column:
    """Sequential replacement phone -> e-mail -> register -> long number.

    ``order="register_first"`` runs the register pattern before the phone
    pattern, so register numbers are tagged instead of swallowed as phones.
    """
    steps = [
        (P.PHONE_JAVA, P.TOKEN_PHONE),
        (P.EMAIL_JAVA, P.TOKEN_EMAIL),
        (P.REGISTER_JAVA, P.TOKEN_REGISTER),
        (P.LONG_NUMBER_JAVA, P.TOKEN_NUMBER),
    ]
    if order == "register_first":
        steps = [steps[2], steps[0], steps[1], steps[3]]
    elif order != "reference":
        raise ValueError(f"unknown redaction order {order!r}")
    orig = _c(col)
    out = orig
    for pattern, token in steps:
        replaced = F.regexp_replace(out, pattern, token.replace("$", "\\$"))
        if pattern == P.EMAIL_JAVA:
            # no step creates or removes '@', so the original text decides; only one
            # branch is evaluated per row
            replaced = F.when(orig.contains("@"), replaced).otherwise(out)
        out = replaced
    return out


# --- Reasoning tags --------------------------------------------------------

def strip_reasoning(col) -> Column:
    """Remove closed ``<think ...>...</think>`` blocks, then strip."""
    return py_strip(F.regexp_replace(_c(col), P.THINK_BLOCK_JAVA, ""))


def has_reasoning_tag(col) -> Column:
    """Case-insensitive ``<think`` or ``</think>`` substring (smoke-inference check)."""
    low = F.lower(_c(col))
    return low.contains("<think") | low.contains("</think>")


def has_think_tag_regex(col) -> Column:
    """Regex ``</?think\\b`` case-insensitive (v3 quality gate)."""
    return _c(col).rlike(P.THINK_TAG_JAVA)
