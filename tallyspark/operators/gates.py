"""Record gates (F1-F4, F7, F8, F11) as predicates and reports.

Gates are plain Column predicates, so ``filter`` keeps them as data filters that
Catalyst can push into the parquet scan when they touch stored columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import dims

PROVENANCE_FIELDS = ("source_url", "license_status", "retrieval_date", "allowed_usage")


def truthy(col) -> Column:
    """Python truthiness of a string: non-null and non-empty (' ' is truthy)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string") != "", F.lit(False))


def truthy_flag(df: DataFrame, name: str) -> Column:
    """Python truthiness of a flag column of any type: booleans as they are, numbers unless 0, strings unless empty."""
    kind = df.schema[name].dataType.simpleString()
    if kind == "boolean":
        return F.coalesce(F.col(name), F.lit(False))
    if kind == "string":
        return truthy(name)
    return F.coalesce(F.col(name) != 0, F.lit(False))


def rights_ok(license_col="license_status", usage_col="allowed_usage") -> Column:
    """both rights fields truthy."""
    return truthy(license_col) & truthy(usage_col)


def provenance_missing(fields=PROVENANCE_FIELDS) -> Column:
    """names of absent provenance fields, in order."""
    return F.array_compact(F.array(*[F.when(~truthy(f), F.lit(f)) for f in fields]))


def pii_exclusion(df: DataFrame) -> DataFrame:
    """drop rows with truthy ``contains_raw_customer_pii`` or ``google_translate_gold`` exactly true."""
    return df.filter(pii_kept(df))


def pii_kept(df: DataFrame) -> Column:
    """F3 as a predicate. Only a boolean true marks gold translations; other types never do."""
    raw = truthy_flag(df, "contains_raw_customer_pii") if "contains_raw_customer_pii" in df.columns else F.lit(False)
    gold = F.lit(False)
    if "google_translate_gold" in df.columns and df.schema["google_translate_gold"].dataType.simpleString() == "boolean":
        gold = F.col("google_translate_gold").eqNullSafe(True)
    return ~raw & ~gold


def declared_pii_gate(df: DataFrame, allow_pii: bool = False) -> tuple[DataFrame, Column]:
    """(accepted rows, rejected-count aggregate column). Only boolean true rejects."""
    rejected = F.col("contains_pii").eqNullSafe(True)
    if allow_pii:
        return df, F.lit(0)
    return df.filter(~rejected), F.count_if(rejected)


def size_guard(n_accepted: Column, allow_small: bool = False, minimum: int = 20) -> Column:
    """F8: guard status text for an accepted-row count."""
    return (F.when(n_accepted == 0, F.lit("error: no records accepted"))
             .when((n_accepted < minimum) & F.lit(not allow_small), F.lit("error: dataset too small"))
             .otherwise(F.lit("ok")))


def generation_guard(n: Column, minimum: int = 2000) -> Column:
    """F8: the v2 generator refuses fewer than 2000 records."""
    return F.when(n < minimum, F.lit("error: count must be at least 2000")).otherwise(F.lit("ok"))


def field_domain_violations(checks: dict) -> Column:
    """``checks`` maps a rule name to a Column that is true when the value is valid."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))


# --- documents with derived provenance -----------------------------------------------------

# first line mentioning a license, anchored at line starts so the scan stays linear
LICENSE_LINE = "(?md)^[^\\n]*?[Ll]icen[cs]e[^\\n]*"
LICENSE_LINE_RE2 = "(?m)^[^\\n]*?[Ll]icen[cs]e[^\\n]*"


def document_provenance(docs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Provenance view of driver documents: the license line found in the text, and
    the manifest entry registered for the document's source (source ``srcK`` ->
    manifest row K mod 12; a broadcast equi-join against the 12-row dimension)."""
    n = len(dims.MANIFEST)
    k = F.regexp_extract(F.col("source"), "([0-9]+)", 1)
    keyed = docs.withColumn("_mord", F.when(k != "", F.pmod(k.cast("bigint"), F.lit(n)).cast("int")))
    m = manifest.select(F.col("ord").alias("_mord"), F.col("name").alias("manifest_name"), "source_url",
                        "allowed_usage", "retrieval_date")
    lic = F.regexp_extract(F.col("text"), LICENSE_LINE, 0)
    return (keyed.join(F.broadcast(m), "_mord", "left")
                 .withColumn("license_status", F.when(lic != "", lic)).drop("_mord"))


def usage_eligible(usage_col="allowed_usage") -> Column:
    """the source's allowed usage permits training (bank sites are benchmark-only)."""
    return F.coalesce(F.col(usage_col).isin(*dims.TRAINING_USAGES), F.lit(False))


def preference_pair_gate(df: DataFrame, lexicon=None) -> DataFrame:
    """P10 (documented): chosen/rejected/rationale/compliance_category present; the chosen
    answer must be compliant and the rejected one non-compliant under the lexicon scan."""
    from ..functions import lending as L
    present = provenance_missing(("chosen", "rejected", "rationale", "compliance_category"))
    low = df.withColumns({"_chosen_low": F.lower("chosen"), "_rejected_low": F.lower("rejected")})  # one lower() a text for all phrases
    return (low.withColumn("missing_fields", present)
              .withColumn("chosen_safe", F.size(L.compliance_issues(F.col("chosen"), lexicon, F.col("_chosen_low"))) == 0)
              .withColumn("rejected_unsafe", F.size(L.compliance_issues(F.col("rejected"), lexicon, F.col("_rejected_low"))) > 0)
              .drop("_chosen_low", "_rejected_low")
              .withColumn("pair_ok", (F.size("missing_fields") == 0) & F.col("chosen_safe") & F.col("rejected_unsafe")))
