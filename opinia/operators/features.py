"""The bridge to pyspark.ml: numbered vocabularies and sparse feature vectors."""

from __future__ import annotations

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.operators.materialize import materialize
from opinia.operators.prefix_sums import hash_buckets, running_total
from opinia.operators.scaling import scaling_factors
from opinia.operators.terms import tfidf_vectors, vocabulary, with_idf


def numbered_vocabulary(words: DataFrame) -> DataFrame:
    """Add ``idx`` 0..size-1, in a fixed order made from a hash. Written out: numbers must never change between passes."""
    return materialize(running_total(hash_buckets(words, "term"), ["term"], output="idx"))


def fit_vectoriser(
    terms: DataFrame, max_df: float = 0.5, min_df: float = 1, max_features: int | None = None
) -> DataFrame:
    """(term, df, cf, idf, idx) from the doc_terms of the training documents."""
    n_docs = terms.count()
    return numbered_vocabulary(with_idf(vocabulary(terms, n_docs, max_df, min_df, max_features), n_docs))


def with_scaling(words: DataFrame, terms: DataFrame, scaler: str, n_docs: int) -> DataFrame:
    """The vocabulary with the factors of a scaler fitted on the training documents; vectors then come out scaled,
    and stay sparse."""
    factors = scaling_factors(tfidf_vectors(terms, words), scaler, n_docs).select("term", "scale", "shift")
    return materialize(words.join(factors, "term"))


def sparse_rows(terms: DataFrame, words: DataFrame) -> DataFrame:
    """doc_terms -> (doc_id, ..., indices array<int>, values array<double>), indices ascending. Unit length unless the
    vocabulary scales."""
    vectors = tfidf_vectors(terms, words, name="idx")
    kept = [c for c in vectors.columns if c != "weights"]
    ordered = vectors.select(*kept, F.sort_array("weights").alias("weights"))
    return ordered.select(
        *kept,
        F.col("weights.idx").cast("array<int>").alias("indices"),
        F.col("weights.w").alias("values"),
    )


def sparse_features(terms: DataFrame, words: DataFrame, size: int) -> DataFrame:
    """doc_terms -> (doc_id, ..., features) with pyspark.ml sparse vectors."""
    rows = sparse_rows(terms, words)
    kept = [c for c in rows.columns if c not in ("indices", "values")]

    @F.udf(returnType=VectorUDT(), useArrow=True)
    def vector(indices, values):
        return Vectors.sparse(size, indices, values)

    return rows.select(*kept, vector("indices", "values").alias("features"))
