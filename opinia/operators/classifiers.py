"""All classifiers behind one face: ``fit_classifier(terms, settings)`` gives a model whose ``predict(terms)`` returns
(doc_id, ..., predicted). Vectoriser, scaling and reduction are fitted together with the classifier."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IndexToString, StringIndexerModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import SparseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.operators import naive_bayes
from opinia.operators.dual import Margin, fit_margins
from opinia.operators.features import fit_vectoriser, sparse_features, sparse_rows, with_scaling
from opinia.operators.forest import Forest, Growth, fit_forest
from opinia.operators.linear import ActiveWeights, fit_l1, fit_squared_hinge
from opinia.operators.materialize import materialize, passing_tables, shrink_partitions
from opinia.operators.neighbours import knn_predict
from opinia.operators.reduction import fit_svd
from opinia.operators.scaling import SCALERS
from opinia.operators.sgd import fit_sgd
from opinia.operators.term_blocks import document_sums

BAYES = {"multinomialnb": "multinomial", "complementnb": "complement", "gaussiannb": "gaussian"}
# A pass over fewer rows than this is not worth another task.
ROWS_PER_PARTITION = 2000
CLASSIFIERS = [*BAYES, "linearsvc", "sgd", "randomforest", "decisiontree", "knn"]


@dataclass(frozen=True)
class ClassifierSettings:
    """Names and defaults of one model. ``svd_components`` replaces the scaler by SVD and row normalisation."""

    classifier: str = "linearsvc"
    max_df: float = 0.5
    min_df: float = 2
    max_features: int | None = None
    scaler: str = "none"
    svd_components: int | None = None
    C: float = 1.0
    loss: str = "squared_hinge"
    penalty: str = "l2"
    tol: float = 1e-4
    max_iter: int = 1000
    alpha: float = 1e-4
    trees: int = 50
    neighbours: int = 5
    seed: int = 17

    def __post_init__(self):
        if self.classifier not in CLASSIFIERS:
            raise ValueError(f"unknown classifier {self.classifier!r}, expected one of {', '.join(CLASSIFIERS)}")
        if self.scaler not in SCALERS:
            raise ValueError(f"unknown scaler {self.scaler!r}, expected one of {', '.join(SCALERS)}")
        if self.classifier == "linearsvc" and (self.loss not in ("hinge", "squared_hinge") or self.penalty not in ("l1", "l2")):
            raise ValueError(f"unknown loss or penalty: {self.loss}, {self.penalty}")
        if self.classifier == "linearsvc" and self.loss == "hinge" and self.penalty == "l1":
            raise ValueError("the hinge loss goes with the l2 penalty only")

    @property
    def skipped(self) -> bool:
        """Naive Bayes takes no SVD features."""
        return self.svd_components is not None and self.classifier in BAYES


def _arrays(df: DataFrame, column: str) -> DataFrame:
    """A vector column as indices and values, the form neighbours and the squared-hinge fit read."""

    @F.udf(returnType="struct<indices: array<int>, values: array<double>>", useArrow=True)
    def parts(vector):
        if isinstance(vector, SparseVector):
            return vector.indices.tolist(), vector.values.tolist()
        return list(range(len(vector))), vector.toArray().tolist()

    kept = [c for c in ("doc_id", "class") if c in df.columns]
    return df.select(*kept, parts(column).alias("_parts")).select(*kept, "_parts.*")


class Hyperplane(Transformer):
    """vector -> prediction: 1.0 on the positive side of the plane."""

    def __init__(self, column: str, weights: np.ndarray, intercept: float):
        super().__init__()
        self.column, self.weights, self.intercept = column, weights, intercept

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared, intercept = dataset.sparkSession.sparkContext.broadcast(self.weights), self.intercept

        @F.udf(returnType="double", useArrow=True)
        def side(vector):
            if isinstance(vector, SparseVector):
                margin = vector.values @ shared.value[vector.indices]
            else:
                margin = vector.toArray() @ shared.value
            return 1.0 if margin + intercept > 0 else 0.0

        return dataset.withColumn("prediction", side(self.column))


@dataclass
class NeighbourModel:
    """``rows`` turns doc_terms into doc_id, indices, values."""

    known: DataFrame
    rows: Callable[[DataFrame], DataFrame]
    k: int

    def predict(self, terms: DataFrame) -> DataFrame:
        return terms.drop("terms").join(knn_predict(self.rows(terms), self.known, self.k), "doc_id")


@dataclass
class WeightModel:
    """A linear model as a table: (term, df, idf, w, shift) and an intercept. A document's score is the sum of its weights
    times ``w`` less the ``shift`` of each of its terms. ``converged`` tells whether the fit ended by its own measure, not
    by its number of rounds; None where the fit does not tell."""

    table: DataFrame
    intercept: float
    negative: str
    positive: str
    converged: bool | None = None

    def predict(self, terms: DataFrame) -> DataFrame:
        kept = [c for c in terms.columns if c != "terms"]
        sums = {"_norm2": (None, 2), "_w": ("w", 1), "_shift": ("shift", 0)}
        score = F.coalesce(F.col("_w") / F.sqrt("_norm2") - F.col("_shift"), F.lit(0.0)) + F.lit(self.intercept)
        scored = document_sums(terms, self.table, ["w", "shift"], sums).select(*kept, score.alias("score"))
        label = F.when(F.col("score") > 0, F.lit(self.positive)).otherwise(F.lit(self.negative))
        return scored.select(*kept, label.alias("predicted"), "score")


@dataclass
class ForestModel:
    """Trees on sparse rows; ``rows`` turns doc_terms into them."""

    words: DataFrame
    rows: Callable[[DataFrame], DataFrame]
    forest: Forest

    def predict(self, terms: DataFrame) -> DataFrame:
        return terms.drop("terms").join(self.forest.predict(self.rows(terms)), "doc_id")


@dataclass
class VectorModel:
    """Fitted pyspark.ml stages on vectors; ``featurise`` turns doc_terms into them."""

    words: DataFrame
    featurise: Callable[[DataFrame], DataFrame]
    stages: Any

    def predict(self, terms: DataFrame) -> DataFrame:
        kept = [c for c in terms.columns if c != "terms"]
        return self.stages.transform(self.featurise(terms)).select(*kept, "predicted")


TREES = {
    "randomforest": lambda settings: Growth(settings.trees, seed=settings.seed),
    "decisiontree": lambda settings: Growth(1, sampled=False, min_split=10, min_decrease=0.005, seed=settings.seed),
}


def fit_classifier(terms: DataFrame, settings: ClassifierSettings = ClassifierSettings()):
    """Fit on doc_terms with a ``class`` column."""
    if settings.skipped:
        raise ValueError("Naive Bayes cannot be fitted on SVD features")
    name, plain = settings.classifier, settings.scaler == "none" and settings.svd_components is None
    limits = (settings.max_df, settings.min_df, settings.max_features)
    if name in BAYES and plain:
        return naive_bayes.fit_naive_bayes(terms, BAYES[name], 1.0, *limits)
    if name == "knn" and plain:
        words = fit_vectoriser(terms, *limits)
        return NeighbourModel(sparse_rows(terms, words), lambda t: sparse_rows(t, words), settings.neighbours)

    classes = list(naive_bayes.class_sizes(terms))
    if name in ("linearsvc", "sgd") and len(classes) != 2:
        raise ValueError(f"linear models need two classes, found {len(classes)}")
    words = fit_vectoriser(terms, *limits)
    size, n_docs = words.count(), terms.count()
    options = dict(positive=classes[-1], C=settings.C, penalty=settings.penalty, tol=settings.tol, max_steps=settings.max_iter)
    if settings.scaler != "none" and settings.svd_components is None:
        words = with_scaling(words, terms, settings.scaler, n_docs)
    if name == "linearsvc" and settings.penalty == "l2" and settings.svd_components is None:
        with passing_tables() as keep:
            fitted = fit_margins(sparse_rows(terms, words), n_docs, classes[-1], [Margin(settings.C, settings.loss)])
            weights = keep(materialize(fitted.weights().select("idx", F.col("w")[0].alias("w"))))
        return WeightModel(_unscaled(words.join(weights, "idx")), weights.where("idx = -1").first()["w"], *classes, fitted.progress.converged)
    if name == "sgd" and settings.svd_components is None:
        with passing_tables() as keep:
            fitted = fit_sgd(sparse_rows(terms, words), classes[-1], settings.alpha, settings.max_iter, seed=settings.seed)
            keep(fitted.weights)
        return WeightModel(_unscaled(words.join(fitted.weights, "idx")), fitted.intercept, *classes, fitted.converged)
    if name == "linearsvc" and settings.svd_components is None:
        with passing_tables():
            fitted = fit_l1(sparse_rows(terms, words), classes[-1], settings.C, settings.tol, settings.max_iter)
        return WeightModel(_unscaled(_with_weights(words, fitted)), fitted.intercept, *classes, fitted.converged)
    projection = None
    if settings.svd_components is not None:
        # Replaces the scaler.
        projection = fit_svd(sparse_rows(terms, words), settings.svd_components)

    def featurise(found: DataFrame) -> DataFrame:
        return sparse_features(found, words, size) if projection is None else _unit_features(found, projection.reduce(sparse_rows(found, words)))

    if name in TREES:
        def rows_of(found: DataFrame) -> DataFrame:
            return sparse_rows(found, words) if projection is None else _arrays(featurise(found), "features")

        growth = TREES[name](settings)
        width = size if projection is None else len(projection.values)
        with passing_tables() as keep:
            forest = fit_forest(rows_of(terms), classes, width, growth)
            keep(forest.splits), keep(forest.ends)
        return ForestModel(words, rows_of, forest)
    # Iterative fits read the features many times.
    features = shrink_partitions(materialize(featurise(terms)), ROWS_PER_PARTITION)
    names = IndexToString(inputCol="prediction", outputCol="predicted", labels=classes)
    if name == "knn":
        return NeighbourModel(_arrays(features, "features"), lambda t: _arrays(featurise(t), "features"), settings.neighbours)
    if name in ("linearsvc", "sgd"):
        width = size if projection is None else len(projection.values)
        rows = _arrays(features, "features")
        # Where these do not stay a table there are as many weights as components.
        weights = np.zeros(width)
        if name == "sgd":
            fitted = fit_sgd(rows, classes[-1], settings.alpha, settings.max_iter, seed=settings.seed)
            for r in fitted.weights.collect():
                weights[r["idx"]] = r["w"]
            plane = Hyperplane("features", weights, fitted.intercept)
        elif settings.penalty == "l2":
            found = {r["idx"]: r["w"][0] for r in fit_margins(rows, n_docs, classes[-1], [Margin(settings.C, settings.loss)]).weights().collect()}
            intercept = found.pop(-1)
            weights[list(found)] = list(found.values())
            plane = Hyperplane("features", weights, intercept)
        else:
            fitted = fit_squared_hinge(rows, width, **options)
            plane = Hyperplane("features", fitted.weights, fitted.intercept)
        return VectorModel(words, featurise, PipelineModel([plane, names]))
    indexer = StringIndexerModel.from_labels(classes, inputCol="class", outputCol="label")
    columns = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction"}
    fitted = NaiveBayes(modelType=BAYES[name], smoothing=1.0, **columns).fit(indexer.transform(features))
    return VectorModel(words, featurise, PipelineModel([fitted, names]))


def _unit_features(terms: DataFrame, reduced: DataFrame) -> DataFrame:
    """doc_terms -> (doc_id, ..., features): projected rows, brought to length one."""
    length = F.sqrt(F.aggregate("reduced", F.lit(0.0), lambda total, x: total + x * x))
    unit = reduced.withColumn("_length", length).select("doc_id", F.transform("reduced", lambda x: F.when(F.col("_length") > 0, x / F.col("_length")).otherwise(0.0)).alias("unit"))
    return terms.drop("terms").join(unit, "doc_id").withColumn("features", array_to_vector("unit")).drop("unit")


def _unscaled(words: DataFrame) -> DataFrame:
    """(term, df, idf, w, shift): weights of scaled features as weights of the plain ones."""
    if "scale" not in words.columns:
        return words.select("term", "df", "idf", "w", F.lit(0.0).alias("shift"))
    return words.select("term", "df", "idf", (F.col("w") / F.col("scale")).alias("w"), (F.col("w") * F.col("shift") / F.col("scale")).alias("shift"))


def _with_weights(words: DataFrame, fitted: ActiveWeights) -> DataFrame:
    """The vocabulary with the driver's weights, zero where there is none: those terms still count for a document's length."""
    found = pd.DataFrame({"idx": fitted.places, "w": fitted.weights})
    table = words.sparkSession.createDataFrame(found, "idx long, w double")
    return words.join(table, "idx", "left").withColumn("w", F.coalesce("w", F.lit(0.0)))


def feature_importances(model: ForestModel, n: int = 30) -> DataFrame:
    """(term, importance): the n most important features of a fitted forest or tree."""
    ranked = model.forest.importances()
    return model.words.join(ranked, "idx").select("term", "importance").orderBy(F.desc("importance"), "term").limit(n)
