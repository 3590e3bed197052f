"""Naive Bayes on TF-IDF vectors, fitted and applied in long form.

Fitting sums weights per term and class; the fitted model is a table with one row per term, next to a handful of
numbers per class. Scoring joins term rows with that table and adds up per document. Neither documents nor vocabulary
ever reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinia.operators.materialize import drop, materialize
from opinia.operators.term_blocks import class_sums, counted_terms, document_sums, packed
from opinia.operators.terms import limited, with_idf

KINDS = ("multinomial", "complement", "gaussian")
# More distinct labels than this are taken for a mistake in the label column.
MOST_CLASSES = 1000


def class_sizes(docs: DataFrame) -> dict[str, int]:
    """Documents per class, classes in alphabetical order."""
    rows = docs.groupBy("class").agg(F.count("*").alias("n")).orderBy("class").limit(MOST_CLASSES + 1).collect()
    if len(rows) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    return {r["class"]: r["n"] for r in rows}


def best_class(scores: list[Column], classes: list[str]) -> Column:
    """The class with the largest score; the first one where scores are equal."""
    best, label = scores[0], F.lit(classes[0])
    for score, name in zip(scores[1:], classes[1:]):
        label = F.when(score > best, F.lit(name)).otherwise(label)
        best = F.greatest(best, score)
    return label


@dataclass
class NaiveBayesModel:
    """``terms`` holds (term, df, idf, a_<i>, b_<i>): a document's score for class i is
    base[i] + sum(w * b_i) + sum(w^2 * a_i) over its weights w."""

    kind: str
    classes: list[str]
    base: list[float]
    terms: DataFrame

    def predict(self, terms: DataFrame) -> DataFrame:
        """doc_terms -> (doc_id, ..., predicted, score). Terms outside the vocabulary do not count."""
        kept = [c for c in terms.columns if c != "terms"]
        count = range(len(self.classes))
        squares = self.kind == "gaussian"
        sums = {"_norm2": (None, 2)} | {f"_b{i}": (f"b_{i}", 1) for i in count}
        if squares:
            sums |= {f"_a{i}": (f"a_{i}", 2) for i in count}
        per_doc = document_sums(terms, self.terms, [v for v, _ in sums.values() if v], sums)

        def score(i: int) -> Column:
            linear = F.coalesce(F.col(f"_b{i}") / F.sqrt("_norm2"), F.lit(0.0))
            square = F.coalesce(F.col(f"_a{i}") / F.col("_norm2"), F.lit(0.0)) if squares else F.lit(0.0)
            return F.lit(self.base[i]) + linear + square

        scores = [score(i) for i in count]
        return per_doc.select(
            *kept, best_class(scores, self.classes).alias("predicted"), F.greatest(*scores).alias("score")
        )


def multinomial_logs(sums: list[Column], totals: list, n_terms, alpha: float) -> list[Column]:
    """Smoothed log probabilities of a term given each class."""
    return [F.log(s + alpha) - F.log(F.lit(t) + F.lit(alpha) * n_terms) for s, t in zip(sums, totals)]


def complement_logs(sums: list[Column], totals: list, n_terms, alpha: float) -> list[Column]:
    """Negated log probabilities of a term given all the other classes."""
    everything = sum(sums[1:], sums[0])
    whole = sum(totals[1:], totals[0])
    return [
        F.log(F.lit(whole) - t + F.lit(alpha) * n_terms) - F.log(everything - s + alpha)
        for s, t in zip(sums, totals)
    ]


def fit_naive_bayes(
    terms: DataFrame,
    kind: str = "complement",
    alpha: float = 1.0,
    max_df: float = 0.5,
    min_df: float = 1,
    max_features: int | None = None,
) -> NaiveBayesModel:
    """Vocabulary, TF-IDF and model from the doc_terms of labelled documents."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}, expected one of {', '.join(KINDS)}")
    # Vocabulary and sums read the blocks: no row of a document and a term is shuffled, and the terms are written once.
    blocks = packed(terms.select("doc_id", "class", "terms"))
    sizes = class_sizes(terms)
    n_docs = sum(sizes.values())
    words = limited(counted_terms(blocks), n_docs, max_df, min_df, max_features)
    stats = materialize(class_sums(blocks, with_idf(words, n_docs), list(sizes)))
    drop(blocks)
    return model_from_sums(stats, sizes, kind, alpha)


def model_from_sums(stats: DataFrame, sizes: dict[str, int], kind: str, alpha: float = 1.0) -> NaiveBayesModel:
    """The model from (term, df, idf, s_<i>, q_<i>)."""
    classes, n_docs = list(sizes), sum(sizes.values())
    count = range(len(classes))
    s = [F.col(f"s_{i}") for i in count]
    q = [F.col(f"q_{i}") for i in count]
    priors = [math.log(n / n_docs) for n in sizes.values()]

    if kind != "gaussian":
        row = stats.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(x), F.lit(0.0)).alias(f"t{i}") for i, x in enumerate(s)]).first()
        totals, n_terms = [row[f"t{i}"] for i in count], row["n"]
        logs = (multinomial_logs if kind == "multinomial" else complement_logs)(s, totals, n_terms, alpha)
        # The complement model has no use for class shares unless there is one class only.
        base = priors if kind == "multinomial" or len(classes) == 1 else [0.0] * len(classes)
        table = stats.select("term", "df", "idf", *[x.alias(f"b_{i}") for i, x in enumerate(logs)])
        return NaiveBayesModel(kind, classes, base, table)

    def variance(total: Column, squares: Column, n: int) -> Column:
        mean = total / n
        return F.greatest(squares / n - mean * mean, F.lit(0.0))

    widest = stats.agg(F.max(variance(sum(s[1:], s[0]), sum(q[1:], q[0]), n_docs)).alias("v")).first()["v"]
    # Variances get a floor relative to the widest column.
    floor = 1e-9 * widest if widest else 1e-9
    means = [x / n for x, n in zip(s, sizes.values())]
    spread = [variance(x, y, n) + floor for x, y, n in zip(s, q, sizes.values())]
    table = stats.select(
        "term", "df", "idf",
        *[(m / v).alias(f"b_{i}") for i, (m, v) in enumerate(zip(means, spread))],
        *[(F.lit(-0.5) / v).alias(f"a_{i}") for i, v in enumerate(spread)],
    )
    # What a document without any of the terms scores: every absent term is a zero.
    row = stats.agg(
        *[F.sum(F.log(v * (2 * math.pi)) + m * m / v).alias(f"z{i}") for i, (m, v) in enumerate(zip(means, spread))]
    ).first()
    base = [p - 0.5 * (row[f"z{i}"] or 0.0) for i, p in enumerate(priors)]
    return NaiveBayesModel(kind, classes, base, table)
