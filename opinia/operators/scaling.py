"""Column scaling of sparse vectors in long form. Absent terms are zeros and count as such."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.operators.lookup import lookup_terms
from opinia.operators.materialize import materialize
from opinia.operators.prefix_sums import ordered_buckets, running_total
from opinia.operators.term_blocks import weighed_blocks, weight_counts, weight_moments
from opinia.operators.terms import weight_rows

SCALERS = ("none", "standard", "minmax", "maxabs", "robust")
QUARTILES = [0.25, 0.75]


def _moments(vectors: DataFrame) -> DataFrame:
    return weight_rows(vectors).groupBy("term").agg(
        F.count("*").alias("n"),
        F.sum("w").alias("sum"),
        F.sum(F.col("w") * F.col("w")).alias("squares"),
        F.min("w").alias("min"),
        F.max("w").alias("max"),
    )


def _usable(scale):
    """A constant column is left as it is."""
    return F.when(scale > 0, scale).otherwise(1.0)


def weight_quantile_rows(vectors: DataFrame, n_docs: int, quantiles: list[float]) -> DataFrame:
    """(term, q, value): exact quantiles (linear) of each term's weights with its zeros, for positive weights.

    Zeros come first, so only terms held by enough documents have a quantile above zero; there are at most
    (terms per document / share of documents) such terms. Equal weights are merged before they are numbered, and
    numbering goes by buckets, so neither a hot term nor a crowd of copies lands in one task.
    """
    lowest_share = 1 - max(quantiles)
    sizes = weight_rows(vectors).groupBy("term").agg(F.count("*").alias("n"))
    wide = sizes.where(F.col("n") > lowest_share * (n_docs - 1))
    # Written out, as numbering reads it several times.
    merged = weight_rows(vectors).groupBy("term", "w").agg(F.count("*").alias("times")).join(wide, "term")
    return _quantiles(materialize(merged), n_docs, quantiles)


def _quantiles(merged: DataFrame, n_docs: int, quantiles: list[float]) -> DataFrame:
    """(term, q, value) from (term, n, w, times)."""
    placed = running_total(
        ordered_buckets(merged, "w"), ["w"], output="before", value=F.col("times"), by=["term"]
    )
    zeros = F.lit(n_docs) - F.col("n")
    first, last = zeros + F.col("before"), zeros + F.col("before") + F.col("times") - 1
    positions = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(q * (n_docs - 1)).alias("at")) for q in quantiles])
    spots = placed.select(
        "term", "n", "w", first.alias("first"), last.alias("last"), F.explode(positions).alias("p")
    ).select("term", "n", "w", "first", "last", "p.q", "p.at")
    covers = [(F.col("first") <= spot) & (spot <= F.col("last")) for spot in (F.floor("at"), F.ceil("at"))]
    low, high = [F.max(F.when(c, F.col("w"))) for c in covers]
    picked = spots.where(covers[0] | covers[1]).groupBy("term", "q", "at").agg(
        F.coalesce(low, F.lit(0.0)).alias("low"), F.coalesce(high, F.lit(0.0)).alias("high")
    )
    part = F.col("at") - F.floor("at")
    return picked.select("term", "q", (F.col("low") + (F.col("high") - F.col("low")) * part).alias("value"))


def scaling_factors(vectors: DataFrame, scaler: str, n_docs: int) -> DataFrame:
    """(term, n, scale, shift), fitted on ``vectors``.

    standard divides by the population deviation and robust by the interquartile range, both without centring
    (centring would fill in the zeros); minmax maps the range to 0..1; maxabs divides by the largest magnitude.
    """
    quantiles = weight_quantile_rows(vectors, n_docs, QUARTILES) if scaler == "robust" else None
    return _factors(_moments(vectors), quantiles, scaler, n_docs)


def _factors(moments: DataFrame, quantiles: DataFrame | None, scaler: str, n_docs: int) -> DataFrame:
    """The moments with scale and shift."""
    if scaler not in SCALERS[1:]:
        raise ValueError(f"unknown scaler {scaler!r}, expected one of {', '.join(SCALERS)}")
    factors = moments
    shift = F.lit(0.0)
    if scaler == "maxabs":
        scale = F.greatest(F.abs("min"), F.abs("max"))
    elif scaler == "standard":
        mean = F.col("sum") / n_docs
        scale = F.sqrt(F.greatest(F.col("squares") / n_docs - mean * mean, F.lit(0.0)))
    elif scaler == "minmax":
        has_zero = F.col("n") < n_docs
        least = F.when(has_zero, F.least(F.col("min"), F.lit(0.0))).otherwise(F.col("min"))
        most = F.when(has_zero, F.greatest(F.col("max"), F.lit(0.0))).otherwise(F.col("max"))
        shift, scale = least, most - least
    else:
        upper, lower = [F.coalesce(F.max(F.when(F.col("q") == q, F.col("value"))), F.lit(0.0)) for q in (0.75, 0.25)]
        factors = factors.join(quantiles.groupBy("term").agg((upper - lower).alias("iqr")), "term", "left")
        scale = F.coalesce("iqr", F.lit(0.0))
    kept = [c for c in ("term", "n", "idf") if c in factors.columns]
    return factors.select(*kept, _usable(scale).alias("scale"), shift.alias("shift"))


def scale_blocks(blocks: DataFrame, fields: list, words: DataFrame, scaler: str, n_docs: int) -> DataFrame:
    """(doc_id, ..., term, w): fitted on and applied to the TF-IDF weights of packed documents. No row of a document and a term
    is shuffled: blocks send sums for their terms, and ask for their factors."""
    # Read by the quantiles and by the scaling; has the idf along.
    moments = materialize(weight_moments(blocks, words))
    quantiles = None
    if scaler == "robust":
        merged = weight_counts(blocks, moments, (1 - max(QUARTILES)) * (n_docs - 1))
        quantiles = _quantiles(materialize(merged), n_docs, QUARTILES)
    return weight_rows(weighed_blocks(blocks, fields, _factors(moments, quantiles, scaler, n_docs)))


def apply_scaling(vectors: DataFrame, factors: DataFrame) -> DataFrame:
    """(doc_id, ..., term, w) with every term's weights scaled."""
    rows = lookup_terms(weight_rows(vectors), factors, ["scale", "shift"], "n", F.xxhash64("doc_id", "term"))
    return rows.withColumn("w", (F.col("w") - F.col("shift")) / F.col("scale")).drop("scale", "shift")


def scale_vectors(vectors: DataFrame, scaler: str, n_docs: int) -> DataFrame:
    """Fit and apply; ``none`` leaves the weights alone."""
    if scaler == "none":
        return weight_rows(vectors)
    return apply_scaling(vectors, scaling_factors(vectors, scaler, n_docs))
