"""Feature selection by the chi-square score of term weights against classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.operators.terms import weight_rows


def chi2_scores(vectors: DataFrame, class_shares: dict[str, float]) -> DataFrame:
    """(term, chi2): sum over classes of (observed - expected)^2 / expected, where observed is the class's sum of
    weights and expected its share of the documents times the term's sum."""
    sums = weight_rows(vectors).groupBy("term").agg(
        F.sum("w").alias("total"),
        *[F.sum(F.when(F.col("class") == c, F.col("w")).otherwise(0.0)).alias(f"_{i}") for i, c in enumerate(class_shares)],
    )
    score = F.lit(0.0)
    for i, share in enumerate(class_shares.values()):
        expected = F.lit(share) * F.col("total")
        score = score + F.pow(F.col(f"_{i}") - expected, 2) / expected
    return sums.select("term", score.alias("chi2"))


def chi2_top_terms(vectors: DataFrame, class_shares: dict[str, float], k: int) -> DataFrame:
    """The k best terms. Scores that agree to nine digits count as ties and go alphabetically."""
    return chi2_scores(vectors, class_shares).orderBy(F.desc(F.round("chi2", 9)), "term").limit(k)
