"""Vocabulary, vectors, scaling, selection and numbering against plain Python on small data."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinia.operators import lookup, prefix_sums, scaling, selection, term_blocks, terms
from opinia.operators.materialize import materialize

DOCS = [["a", "b", "b"], ["a", "c"], ["a", "b", "d"], ["c", "c", "e"], []]


@pytest.fixture(scope="module")
def counted(spark):
    rows = [(i, "pos" if i < 3 else "neg", d) for i, d in enumerate(DOCS)]
    return terms.doc_terms(spark.createDataFrame(rows, "doc_id long, class string, tokens array<string>"))


def tfidf(docs, vocabulary=None):
    n = len(docs)
    df = Counter(t for d in docs for t in set(d))
    names = sorted(vocabulary or df)
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in names}
    x = np.array([[Counter(d)[t] * idf[t] for t in names] for d in docs])
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return names, x / np.where(norm > 0, norm, 1)


def dense(rows, names, n):
    x = np.zeros((n, len(names)))
    for r in rows:
        x[r["doc_id"], names.index(r["term"])] = r["w"]
    return x


@pytest.fixture(scope="module")
def vectors(counted):
    return terms.tfidf_vectors(counted, terms.with_idf(terms.vocabulary(counted, 5), 5)).cache()


def test_tfidf(vectors):
    names, x = tfidf(DOCS)
    assert vectors.count() == 5
    np.testing.assert_allclose(dense(terms.weight_rows(vectors).collect(), names, 5), x)


@pytest.mark.parametrize(
    "limits, expected",
    [((1.0, 1, None), "abcde"), ((0.5, 1, None), "bcde"), ((2, 2, None), "bc"), ((1.0, 0.4, None), "abc"), ((1.0, 1, 2), "ab")],
)
def test_pruning(counted, limits, expected):
    assert sorted(r["term"] for r in terms.vocabulary(counted, 5, *limits).collect()) == list(expected)


def test_lookup_hot_and_cold(spark, monkeypatch):
    monkeypatch.setattr(lookup, "HOT_TERMS", 1)
    rows = spark.createDataFrame([(i, "hot") for i in range(50)] + [(60, "cold"), (61, "none"), (62, None)], "doc_id long, term string")
    table = spark.createDataFrame([("hot", 1.0, 50), ("cold", 2.0, 1)], "term string, v double, df long")
    joined = lookup.lookup_terms(rows, table, ["v"], "df", F.col("doc_id"), how="left")
    got = Counter((r["term"], r["v"]) for r in joined.collect())
    assert got == {("hot", 1.0): 50, ("cold", 2.0): 1, ("none", None): 1, (None, None): 1}
    assert lookup.lookup_terms(rows, table, ["v"], "df", F.col("doc_id")).count() == 51


@pytest.mark.parametrize("scaler", ["maxabs", "minmax", "standard", "robust"])
def test_scalers_count_zeros(vectors, scaler):
    names, x = tfidf(DOCS)
    if scaler == "maxabs":
        scale = np.abs(x).max(0)
    elif scaler == "minmax":
        scale = x.max(0) - x.min(0)
    elif scaler == "standard":
        scale = x.std(0)
    else:
        scale = np.quantile(x, 0.75, axis=0) - np.quantile(x, 0.25, axis=0)
    expected = x / np.where(scale > 0, scale, 1)
    got = dense(scaling.scale_vectors(vectors, scaler, 5).collect(), names, 5)
    np.testing.assert_allclose(got, expected, atol=1e-12)


def test_quantiles_with_copies_in_one_bucket(spark):
    rng = np.random.default_rng(1)
    values = {t: np.round(rng.random(60), 1) * (rng.random(60) < share) for t, share in [("x", 0.9), ("y", 0.5), ("z", 0.1)]}
    rows = [(i, [(t, float(v[i])) for t, v in values.items() if v[i] > 0]) for i in range(60)]
    vectors = spark.createDataFrame(rows, "doc_id long, weights array<struct<term string, w double>>")
    got = {(r["term"], r["q"]): r["value"] for r in scaling.weight_quantile_rows(vectors, 60, [0.25, 0.75]).collect()}
    for t, v in values.items():
        for q in (0.25, 0.75):
            assert got.get((t, q), 0.0) == pytest.approx(np.quantile(v, q))


def test_unknown_scaler(vectors):
    with pytest.raises(ValueError):
        scaling.scale_vectors(vectors, "log", 5)


def test_chi2(vectors):
    names, x = tfidf(DOCS)
    shares = {"neg": 0.4, "pos": 0.6}
    observed = np.array([x[3:].sum(0), x[:3].sum(0)])
    expected = np.outer([0.4, 0.6], x.sum(0))
    score = ((observed - expected) ** 2 / expected).sum(0)
    got = {r["term"]: r["chi2"] for r in selection.chi2_scores(vectors, shares).collect()}
    np.testing.assert_allclose([got[t] for t in names], score)
    best = [r["term"] for r in selection.chi2_top_terms(vectors, shares, 2).collect()]
    assert best == [names[i] for i in np.argsort(-score, kind="stable")[:2]]


@pytest.mark.parametrize("buckets", [1, 7, 100])
def test_running_total(spark, buckets):
    rng = np.random.default_rng(buckets)
    ids = rng.permutation(200)
    rows = [(int(i), "ab"[int(i % 3 == 0)], int(i % 5)) for i in ids]
    df = spark.createDataFrame(rows, "id long, g string, v long")
    cut = prefix_sums.ordered_buckets(df, "id", buckets=buckets)
    got = prefix_sums.running_total(cut, ["id"], "total", value=F.col("v"), by=["g"]).collect()
    for r in got:
        assert r["total"] == sum(v for i, g, v in rows if g == r["g"] and i < r["id"])
    dense = prefix_sums.running_total(prefix_sums.ordered_buckets(df, "id", buckets=buckets), ["id"], "n")
    assert [r["n"] for r in dense.orderBy("id").collect()] == list(range(200))


def test_hash_numbering_is_dense(spark):
    df = spark.range(500).select(F.concat(F.lit("t"), "id").alias("term"))
    got = prefix_sums.running_total(prefix_sums.hash_buckets(df, "term", buckets=16), ["term"], "idx")
    assert sorted(r["idx"] for r in got.collect()) == list(range(500))


def test_no_shuffle_key_holds_a_large_share(spark, monkeypatch):
    """A word in every document is pruned, another is new to the vocabulary: both must be spread all the same."""
    monkeypatch.setattr(lookup, "HOT_TERMS", 4)
    docs = spark.createDataFrame(
        [(i, ["everywhere", "unknown", f"a{i % 97}", f"b{i % 89}"]) for i in range(600)], "doc_id long, tokens array<string>"
    )
    counted = terms.doc_terms(docs)
    words = terms.with_idf(terms.vocabulary(counted, 600, max_df=0.5).where("term != 'unknown'"), 600)
    rows = terms.term_rows(counted)
    spread = lookup.spread_rows(rows, words, ["idf"], "df", F.xxhash64("doc_id", "term"), "term", terms.frequent_terms(counted))
    largest = spread.groupBy("_probe").count().agg(F.max("count")).first()[0]
    assert largest <= rows.count() / 4 / 50
    joined = lookup.lookup_terms(rows, words, ["idf"], "df", F.xxhash64("doc_id", "term"), how="left", frequent=terms.frequent_terms(counted))
    plain = rows.join(words.select("term", "idf"), "term", "left")
    key = lambda df: sorted((r["doc_id"], r["term"], r["idf"] or 0.0) for r in df.select("doc_id", "term", "idf").collect())
    assert key(joined) == key(plain)


def test_materialize_computes_rows_once(spark):
    """checkpoint() computed them to count and again to write (F13 to F20)."""
    seen = spark.sparkContext.accumulator(0)

    def looked_at(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(0, 1000, 1, 4).selectExpr("id", "array(struct(id as term, 1.0D as w)) as weights", "cast('x' as binary) as payload")
    kept = materialize(df.mapInPandas(looked_at, df.schema))
    assert kept.count() == 1000 and kept.dtypes == df.dtypes
    assert seen.value == 1000
    assert sorted(kept.collect()) == sorted(df.collect())


def test_lookup_asks_once_for_each_term_of_a_block(spark, monkeypatch):
    """Rows to look up grow with blocks x terms, not with documents x terms; any size of block gives the same (F21 to F37)."""
    docs = [(i, [("all", 2), (f"t{i % 3}", 1)] if i else []) for i in range(40)]
    counted = spark.createDataFrame(docs, "doc_id long, terms array<struct<term string, tf long>>").coalesce(1)
    words = terms.with_idf(terms.vocabulary(counted, 40, 1.0, 1), 40).where("term <> 't1'")
    idf = {r["term"]: r["idf"] for r in words.collect()}
    for entries, blocks in ((1 << 19, 1), (10, 8)):
        monkeypatch.setattr(term_blocks, "BLOCK_ENTRIES", entries)
        kept = term_blocks.packed(counted)
        assert kept.count() == blocks
        assert term_blocks.asked(kept).count() == (4 if blocks == 1 else 4 * blocks)
        got = {r["doc_id"]: {x["term"]: x["w"] for x in r["weights"]} for r in terms.tfidf_vectors(counted, words).collect()}
        assert len(got) == 40
        for i, found in docs:
            raw = {t: n * idf[t] for t, n in found if t in idf}
            length = math.sqrt(sum(x * x for x in raw.values()))
            assert got[i] == pytest.approx({t: x / length for t, x in raw.items()})
