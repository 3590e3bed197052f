"""The package's queries: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opinia.llm import bpe, conversations, html, kneser_ney, language, manifest, merkle, packing, pii, quality, secret_scan, simhash, urls
from opinia.llm.oracle import URL_RULES, oracle_sql
from opinia.llm.storage import documents, pages

__all__ = ["queries", "oracle_sql", "URL_RULES"]

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary file lies, on driver and executors alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(documents(spark, folder))


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(documents(spark, folder))


def op3_html(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(pages(spark, folder))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), vocabulary())


def op5_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.edited_fingerprints(documents(spark, folder))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(documents(spark, folder))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_predictions(documents(spark, folder))


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.code_digests(documents(spark, folder).select("doc_id", "text"), vocabulary())


def op9_urls(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(pages(spark, folder), rules)


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.damage_and_repair(spark.read.parquet(f"{folder}/conversations.parquet"))


def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.verified_manifest(documents(spark, folder))


def op13_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.language_model_scores(documents(spark, folder))


def queries() -> dict[str, Query]:
    return {
        "op1_quality": op1_quality,
        "op2_pii": op2_pii,
        "op3_html": op3_html,
        "op4_packing": op4_packing,
        "op5_merkle": op5_merkle,
        "op6_secrets": op6_secrets,
        "op7_language": op7_language,
        "op8_bpe": op8_bpe,
        "op9_urls": op9_urls,
        "op10_simhash": op10_simhash,
        "op11_conversations": op11_conversations,
        "op12_manifest": op12_manifest,
        "op13_language_model": op13_language_model,
    }


