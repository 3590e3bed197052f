"""Stop words: a language's base list with the custom words added and, if wished, the kept words taken out."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession

from opinia.functions.fixed_values import BASE_STOP_WORDS, CUSTOM_STOP_WORDS, KEPT_WORDS


def base_stop_words(language: str = "italian") -> list[str]:
    """The language's base list: our own for Italian, Spark's (which needs a session) for others."""
    return BASE_STOP_WORDS if language == "italian" else StopWordsRemover.loadDefaultStopWords(language)


def stop_words_frame(spark: SparkSession, keep_listed: bool = False, language: str = "italian") -> DataFrame:
    """(word): base list UNION custom words, MINUS the kept words when ``keep_listed``."""
    one_column = "word string"
    base = spark.createDataFrame([(w,) for w in base_stop_words(language)], one_column)
    custom = spark.createDataFrame([(w,) for w in CUSTOM_STOP_WORDS], one_column)
    words = base.union(custom).distinct()
    if keep_listed:
        words = words.subtract(spark.createDataFrame([(w,) for w in KEPT_WORDS], one_column))
    return words


def stop_word_list(keep_listed: bool = False, language: str = "italian") -> list[str]:
    """The same set as a sorted list, for use as literals (a few hundred words, whatever the corpus)."""
    words = set(base_stop_words(language)) | set(CUSTOM_STOP_WORDS)
    return sorted(words - set(KEPT_WORDS) if keep_listed else words)
