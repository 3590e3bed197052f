"""A training corpus in five stages: quality rules, language ID, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. Stages are joined by parquet tables in
the session's shared checkpoint folder, so a lost executor costs a part of one stage. All but the last return the
columns of documents; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinia.llm import language, packing, pii, quality, simhash
from opinia.llm.catalog import vocabulary
from opinia.llm.storage import documents, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality.accepted(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no clear language go."""
    return language.with_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link at three or fewer differing bits stays."""
    return simhash.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose personal data and the terms that give it away."""
    return pii.without_personal_data(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, as pieces of documents."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packed),
]

# Language models, fingerprints and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
