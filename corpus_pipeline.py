"""The training-data pipeline: five stages, each a call of one operator of ``tallyspark.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes it as Parquet into the shared folder
and reads it again as the next one's documents, so a lost executor or a restart costs at most one stage. All stages but
the last return the columns of documents.

1. language_id: documents whose language is unknown or uncertain go.
2. exact_dedup: of equal texts (white space aside) the row with the smallest doc_id stays.
3. simhash_near_dedup: of fingerprints within 3 bits (3-word shingles) one document of each group stays.
4. source_mixing: documents are repeated by Poisson counts to the sources' target weights and shuffled.
5. packing: the mixture is tokenised and packed into sequences of 2048 ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import exact_dedup, language_id, mixing, packing, simhash
from tallyspark.llm.common import materialise
from tallyspark.llm.queries import vocabulary
from tallyspark.sources.tables import table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted_rows(spark, docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(spark, docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(spark, docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(spark, docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("source_mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Language identification, SimHash and packing can't be expressed in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``: one row per packed piece."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
