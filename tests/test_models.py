"""Classifiers against plain numpy on a small corpus, and on separable data."""

import math

import numpy as np
import pytest

from opinia.operators import classifiers, features, linear, naive_bayes, neighbours, reduction, scaling, term_blocks, terms
from opinia.operators.classifiers import ClassifierSettings
from pyspark.sql import functions as F

NEW = ["camera pulita e gentile", "sporca e scortese", "parole ignote soltanto", "", "ottima vista ma rumore"]


@pytest.fixture(scope="module")
def counted(reviews):
    return terms.doc_terms(terms.tokenize(reviews), (1, 2)).cache()


@pytest.fixture(scope="module")
def fresh(spark):
    docs = spark.createDataFrame(list(enumerate(NEW)), "doc_id long, text string")
    return terms.doc_terms(terms.tokenize(docs), (1, 2)).cache()


@pytest.fixture(scope="module")
def matrices(counted, fresh):
    """(training matrix, labels, new matrix) in order of doc_id."""

    def as_dicts(frame):
        return [{t["term"]: t["tf"] for t in r["terms"]} for r in frame.orderBy("doc_id").collect()]

    known, new = as_dicts(counted), as_dicts(fresh)
    labels = np.array([r["class"] for r in counted.orderBy("doc_id").collect()])
    df = {t: sum(t in d for d in known) for d in known for t in d}
    names = sorted(t for t in df if df[t] <= 0.5 * len(known))
    idf = np.array([math.log((1 + len(known)) / (1 + df[t])) + 1 for t in names])

    def matrix(docs):
        x = np.array([[d.get(t, 0) for t in names] for d in docs]) * idf
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return x / np.where(norm > 0, norm, 1)

    return matrix(known), labels, matrix(new)


def predicted(model, frame):
    return [r["predicted"] for r in model.predict(frame).orderBy("doc_id").collect()]


def test_multinomial_and_complement(counted, fresh, matrices):
    x, y, new = matrices
    sums = np.array([x[y == c].sum(0) for c in ("neg", "pos")])
    flp = np.log(sums + 1) - np.log((sums + 1).sum(1, keepdims=True))
    prior = np.log([np.mean(y == c) for c in ("neg", "pos")])
    scores = {"multinomial": new @ flp.T + prior}
    rest = sums.sum(0) - sums + 1
    scores["complement"] = -new @ np.log(rest / rest.sum(1, keepdims=True)).T
    for kind, expected in scores.items():
        model = naive_bayes.fit_naive_bayes(counted, kind)
        rows = model.predict(fresh).orderBy("doc_id").collect()
        np.testing.assert_allclose([r["score"] for r in rows], expected.max(1))
        assert [r["predicted"] for r in rows] == [("neg", "pos")[i] for i in expected.argmax(1)]


def test_gaussian(counted, fresh, matrices):
    x, y, new = matrices
    floor = 1e-9 * x.var(0).max()
    scores = []
    for c in ("neg", "pos"):
        mean, var = x[y == c].mean(0), x[y == c].var(0) + floor
        scores.append(np.log(np.mean(y == c)) - 0.5 * (np.log(2 * np.pi * var) + (new - mean) ** 2 / var).sum(1))
    rows = naive_bayes.fit_naive_bayes(counted, "gaussian").predict(fresh).orderBy("doc_id").collect()
    np.testing.assert_allclose([r["score"] for r in rows], np.max(scores, axis=0), rtol=1e-6)
    assert [r["predicted"] for r in rows] == [("neg", "pos")[i] for i in np.argmax(scores, axis=0)]


@pytest.mark.parametrize("block_docs", [None, 4])
def test_neighbours(counted, fresh, matrices, block_docs):
    x, y, new = matrices
    words = features.fit_vectoriser(counted, 0.5, 1)
    known, unseen = features.sparse_rows(counted, words), features.sparse_rows(fresh, words)
    ids = np.array([r["doc_id"] for r in counted.orderBy("doc_id").collect()])
    distance = np.round(((new[:, None, :] - x[None]) ** 2).sum(2), 9)
    got = neighbours.nearest_neighbours(unseen, known, 5, block_docs).orderBy("doc_id", "rank").collect()
    for i in range(len(new)):
        nearest = ids[np.lexsort((ids, distance[i]))[:5]]
        assert [r["neighbour"] for r in got if r["doc_id"] == i] == nearest.tolist()


def test_pairs_of_blocks_are_not_shuffled(spark):
    rows = spark.range(400).selectExpr(
        "id AS doc_id", "array(cast(id % 7 AS int), cast(7 + id % 5 AS int)) AS indices", "array(0.6D, 0.8D) AS values", "if(id % 2 = 0, 'a', 'b') AS class"
    )
    found = neighbours.nearest_neighbours(rows.drop("class"), rows, 5, 100)
    plan = found._jdf.queryExecution().toString()
    # Blocks were sent to every block of the other side by a shuffle.
    assert "CartesianProduct" in plan and "CoGroups" not in plan
    same = {(r["doc_id"] - r["neighbour"]) % 35 for r in found.where("rank <= 3").collect()}
    assert same == {0} and found.count() == 2000



@pytest.fixture(scope="module")
def sparse(counted):
    words = features.fit_vectoriser(counted, 0.5, 2)
    return words, words.count(), features.sparse_rows(counted, words).cache()


def as_matrix(sparse):
    _, size, rows = sparse
    collected = rows.orderBy("doc_id").collect()
    x = np.zeros((len(collected), size))
    for i, r in enumerate(collected):
        x[i, r["indices"]] = r["values"]
    return x, np.array([1.0 if r["class"] == "pos" else -1.0 for r in collected])


def objective(w, b, x, y, C, penalty):
    loss = (np.maximum(0, 1 - y * (x @ w + b)) ** 2).sum()
    return (w @ w + b * b) / 2 + C * loss if penalty == "l2" else np.abs(w).sum() + abs(b) + C * loss


@pytest.mark.parametrize("penalty", ["l2", "l1"])
def test_squared_hinge_is_a_minimum(sparse, penalty):
    x, y = as_matrix(sparse)
    fitted = linear.fit_squared_hinge(sparse[2], sparse[1], C=3.0, penalty=penalty, tol=1e-6, max_steps=300)
    value = objective(fitted.weights, fitted.intercept, x, y, 3.0, penalty)
    assert value == pytest.approx(fitted.objective)
    rng = np.random.default_rng(0)
    for scale in (1e-1, 1e-2, 1e-3):
        for _ in range(50):
            w = fitted.weights + scale * rng.standard_normal(len(fitted.weights))
            assert objective(w, fitted.intercept, x, y, 3.0, penalty) > value - 1e-5
    if penalty == "l1":
        assert (fitted.weights == 0).any()


def test_squared_hinge_as_a_table_reaches_the_same_minimum(spark, sparse):
    rows = spark.createDataFrame(
        [(i, c, [(t, w) for t, w in d]) for i, (c, d) in enumerate([
            ("pos", [("a", 0.8), ("b", 0.6)]), ("pos", [("a", 1.0)]), ("neg", [("c", 1.0)]), ("neg", [("b", 0.6), ("c", 0.8)]),
        ])],
        "doc_id long, class string, weights array<struct<term string, w double>>",
    )
    weights, intercept = linear.fit_squared_hinge_table(rows, C=1.0, tol=1e-3, max_steps=12)
    got = {r["term"]: r["w"] for r in weights.collect()}
    numbered = rows.selectExpr("class", "transform(weights, x -> ascii(x.term) - 97) as indices", "weights.w as values")
    exact = linear.fit_squared_hinge(numbered, 3, C=1.0, tol=1e-8)
    x = np.array([[0.8, 0.6, 0], [1, 0, 0], [0, 0, 1], [0, 0.6, 0.8]])
    y = np.array([1.0, 1, -1, -1])
    value = objective(np.array([got[t] for t in "abc"]), intercept, x, y, 1.0, "l2")
    assert value == pytest.approx(exact.objective, rel=1e-3)


@pytest.mark.parametrize(
    "settings",
    [
        ClassifierSettings("linearsvc", loss="hinge", C=3.0, max_iter=15),
        ClassifierSettings("linearsvc", C=3.0),
        ClassifierSettings("sgd", max_iter=15),
        ClassifierSettings("randomforest", trees=10),
        ClassifierSettings("randomforest", trees=5, svd_components=4),
        ClassifierSettings("knn", min_df=1),
        ClassifierSettings("complementnb", scaler="maxabs"),
        ClassifierSettings("sgd", svd_components=4, max_iter=15),
        ClassifierSettings("knn", scaler="standard", min_df=1),
        ClassifierSettings("linearsvc", C=3.0, svd_components=4),
        ClassifierSettings("linearsvc", C=3.0, scaler="robust"),
    ],
    ids=lambda s: f"{s.classifier}-{s.loss}-{s.scaler}-{s.svd_components}",
)
def test_separable_reviews_are_learned(counted, settings):
    model = classifiers.fit_classifier(counted, settings)
    rows = model.predict(counted).select("class", "predicted").collect()
    assert len(rows) == 30 and np.mean([r["class"] == r["predicted"] for r in rows]) > 0.9


@pytest.mark.parametrize("settings", [ClassifierSettings("linearsvc"), ClassifierSettings("linearsvc", penalty="l1", loss="squared_hinge", max_iter=1), ClassifierSettings("sgd", max_iter=1)])
def test_linear_models_tell_whether_they_converged(counted, settings):
    assert classifiers.fit_classifier(counted, settings).converged is (settings.max_iter > 1)


def test_importances(counted):
    forest = classifiers.fit_classifier(counted, ClassifierSettings("randomforest", trees=10))
    top = classifiers.feature_importances(forest, 3).collect()
    assert len(top) == 3 and top[0]["importance"] >= top[1]["importance"] >= top[2]["importance"] > 0


@pytest.mark.parametrize("block_docs", [4096, 8])
def test_svd_and_pca(monkeypatch, sparse, block_docs):
    monkeypatch.setattr(reduction, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(reduction, "SHARD_TERMS", 5 if block_docs == 8 else 1 << 16)
    x, _ = as_matrix(sparse)
    for centred, matrix in ((False, x), (True, x - x.mean(0))):
        fitted = (reduction.fit_pca if centred else reduction.fit_svd)(sparse[2], 3)
        expected = np.linalg.svd(matrix)[1][:3]
        np.testing.assert_allclose(fitted.values, expected, rtol=1e-6)
        rows = fitted.reduce(sparse[2]).orderBy("doc_id").collect()
        reduced = np.array([r["reduced"] for r in rows])
        np.testing.assert_allclose(np.linalg.norm(reduced, axis=0), expected, rtol=1e-6)
        axes = np.zeros((x.shape[1], 3))
        for r in fitted.components().collect():
            axes[r["idx"]] = r["v"]
        np.testing.assert_allclose(axes.T @ axes, np.eye(3), atol=1e-8)
        np.testing.assert_allclose(reduced, matrix @ axes, atol=1e-8)


def test_svd_sends_rows_for_documents_not_for_terms(monkeypatch, spark):
    """What is swapped must not hold a dense row for every term of a block."""
    monkeypatch.setattr(reduction, "BLOCK_DOCS", 8)
    monkeypatch.setattr(reduction, "CHUNK_TERMS", 64, raising=False)
    largest, write = [], reduction.materialize

    def watched(df):
        out = write(df)
        if "payload" in out.columns:
            largest.append(out.agg(F.max(F.length("payload"))).first()[0])
        return out

    monkeypatch.setattr(reduction, "materialize", watched)
    rows = [(i, list(range(i % 20 * 1000, i % 20 * 1000 + 1000)), [1.0 + (i * 7 + j) % 13 for j in range(1000)]) for i in range(40)]
    fitted = reduction.fit_svd(spark.createDataFrame(rows, "doc_id long, indices array<int>, values array<double>"), 20, iterations=1)
    assert len(fitted.values) == 20 and fitted.values[-1] > 0
    # 16 bytes for an entry of a block, at most 20 documents in one; 30 columns of 8,000 terms would be 1.9 MB.
    assert max(largest) < 400_000


def test_svd_of_more_components_than_rank(spark):
    rows = spark.createDataFrame([(0, [0, 1], [1.0, 2.0]), (1, [0, 1], [2.0, 4.0]), (2, [], []), (3, [2], [1.0])], "doc_id long, indices array<int>, values array<double>")
    fitted = reduction.fit_svd(rows, 10)
    np.testing.assert_allclose(fitted.values[:2], [5.0, 1.0])
    assert np.all(fitted.values[2:] < 1e-5) and len(fitted.reduce(rows).collect()) == 4


def test_bad_names():
    for bad in ({"classifier": "svr"}, {"scaler": "log"}, {"loss": "log"}, {"loss": "hinge", "penalty": "l1"}):
        with pytest.raises(ValueError):
            ClassifierSettings(**bad)
    assert ClassifierSettings("complementnb", svd_components=10).skipped


def test_scaled_features_stay_sparse(counted, sparse):
    words, size, rows = sparse
    x, _ = as_matrix(sparse)
    scaled = features.with_scaling(words, counted, "standard", 30)
    got, _ = as_matrix((scaled, size, features.sparse_rows(counted, scaled)))
    np.testing.assert_allclose(got, x / x.std(0))


@pytest.mark.parametrize("scaler", ["maxabs", "minmax", "standard", "robust"])
def test_scaling_by_blocks_is_scaling_by_rows(counted, scaler):
    blocks = term_blocks.packed(counted)
    words = terms.with_idf(terms.vocabulary(counted, 30, 0.5), 30)
    by_rows = scaling.scale_vectors(terms.tfidf_vectors(counted, words), scaler, 30)
    by_blocks = scaling.scale_blocks(blocks, term_blocks.other_fields(counted), words, scaler, 30)
    want, got = ({(r["doc_id"], r["term"]): r["w"] for r in df.collect()} for df in (by_rows, by_blocks))
    assert got == pytest.approx(want, rel=1e-9)
    df = {r["term"]: (r["df"], r["cf"]) for r in terms.document_frequency(counted).collect()}
    assert {r["term"]: (r["df"], r["cf"]) for r in term_blocks.counted_terms(blocks).collect()} == df
