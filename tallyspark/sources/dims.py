"""Dimension tables: source manifest (S5), compliance lexicon (S7), glossaries (S6),
benchmark templates (S11). All are small fixed tables; joins against them are
broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab as V

# ---------------------------------------------------------------------------
# FIXED VALUES — source manifest rows: name, category, source_url, license_status,
# allowed_usage, notes (retrieval date is supplied at run time; fetch disabled).
MANIFEST = [
    ("General Mongolian public/open data", "general", "TBD", "verify_before_use", "manifest_only",
     "Add only sources with clear public/open licenses."),
    ("Mongolian Wikipedia", "general", "https://mn.wikipedia.org/", "CC BY-SA; verify dump terms",
     "research_and_training_if_license_compliant", "Prefer official Wikimedia dumps over crawling pages."),
    ("OSCAR Mongolian", "general", "https://oscar-project.org/", "verify_dataset_license",
     "research_and_training_if_license_compliant", "Use dataset access paths and license documentation."),
    ("CC100 Mongolian", "general", "https://data.statmt.org/cc-100/", "verify_dataset_license",
     "research_and_training_if_license_compliant", "Deduplicate and filter quality before training."),
    ("Common Crawl Mongolian candidates", "general", "https://commoncrawl.org/", "verify_page_level_rights",
     "filter_and_review_before_training", "Use URL-level license/robots checks and avoid copyrighted content."),
    ("Public government/legal texts", "legal", "TBD government portals", "verify_public_sector_terms",
     "legal_review_required", "Store document-level license and retrieval metadata."),
    ("Public library metadata/public-domain texts", "general", "TBD library sources",
     "public_domain_or_license_required", "only_where_rights_allow", "Do not ingest copyrighted books without license."),
    ("Khan Bank website", "finance", "https://www.khanbank.com/", "copyrighted_public_site_verify",
     "benchmark_reference_only_until_licensed", "Respect robots.txt; do not scrape aggressively."),
    ("TDB website", "finance", "https://www.tdbm.mn/", "copyrighted_public_site_verify",
     "benchmark_reference_only_until_licensed", "Respect robots.txt; do not scrape aggressively."),
    ("Golomt Bank website", "finance", "https://www.golomtbank.com/", "copyrighted_public_site_verify",
     "benchmark_reference_only_until_licensed", "Respect robots.txt; do not scrape aggressively."),
    ("XacBank website", "finance", "https://www.xacbank.mn/", "copyrighted_public_site_verify",
     "benchmark_reference_only_until_licensed", "Respect robots.txt; do not scrape aggressively."),
    ("State Bank website", "finance", "https://www.statebank.mn/", "copyrighted_public_site_verify",
     "benchmark_reference_only_until_licensed", "Respect robots.txt; do not scrape aggressively."),
]
# allowed_usage values that permit training (possibly after review / license check).
TRAINING_USAGES = ["research_and_training_if_license_compliant", "filter_and_review_before_training",
                   "training_allowed", "training_allowed_after_human_review"]
BENCHMARK_TEMPLATE_METADATA = {"license": "template", "compliance_review_required": "true"}
GENERAL_TEMPLATE_METADATA = {"license": "template", "human_review_required": "true"}
# ---------------------------------------------------------------------------

MANIFEST_SCHEMA = ("ord int, name string, category string, source_url string, license_status string, "
                   "allowed_usage string, notes string, fetch_enabled_by_default boolean")


def source_manifest(spark: SparkSession, retrieval_date=None) -> DataFrame:
    """The 12 manifest rows; ``retrieval_date`` defaults to today (``current_date``)."""
    rows = [(i, *r[:5], r[5], False) for i, r in enumerate(MANIFEST)]
    df = spark.createDataFrame(rows, MANIFEST_SCHEMA)
    date = F.lit(retrieval_date).cast("date") if retrieval_date else F.current_date()
    return df.withColumn("retrieval_date", date.cast("string"))


def lexicon_table(spark: SparkSession) -> DataFrame:
    """(ord, category, phrase, severity, alternative)."""
    return spark.createDataFrame(V.lexicon_rows(), "ord int, category string, phrase string, severity string, alternative string")


def glossary_table(spark: SparkSession, glossary_id: str | None = None) -> DataFrame:
    """Merged glossary as (glossary_id, ord, term, preferred)."""
    rows = [(glossary_id or "default", i, t, p) for i, (t, p) in enumerate(V.merged_glossary(glossary_id))]
    return spark.createDataFrame(rows, "glossary_id string, ord int, term string, preferred string")


def attach_template_metadata(items: DataFrame, metadata: dict = BENCHMARK_TEMPLATE_METADATA) -> DataFrame:
    """Constant metadata map attached to benchmark template items (bank metadata unless given)."""
    kv = []
    for k, v in metadata.items():
        kv += [F.lit(k), F.lit(v)]
    return items.withColumn("metadata", F.create_map(*kv))
