"""What stays on disk: shuffle files and tables that nothing reads any more."""

import os
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opinia.operators import dual, evaluation, naive_bayes, reduction, sgd, term_blocks
from opinia.operators.classifiers import ClassifierSettings, fit_classifier
from opinia.operators.materialize import CLEANED, checkpoint_folder, drop, materialize, passing_tables
from opinia.plans import catalog, search


def tables(spark):
    folder = checkpoint_folder(spark).removeprefix("file:")
    return {name for name in os.listdir(folder) if name.startswith("table-")}


def shuffled_files(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").count("shuffle_")


@pytest.fixture
def vectors(spark):
    deal, rows = np.random.default_rng(3), []
    for i in range(60):
        at = np.sort(deal.choice(40, 6, replace=False))
        rows.append((i, "pos" if at[0] % 2 else "neg", at.tolist(), deal.random(6).tolist()))
    return spark.createDataFrame(rows, "doc_id long, class string, indices array<int>, values array<double>")


def test_shuffle_files_go_with_the_write(spark):
    before, setting = shuffled_files(spark), spark.conf.get(CLEANED)
    table = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert shuffled_files(spark) <= before and spark.conf.get(CLEANED) == setting
    assert {r["k"]: r["count"] for r in table.collect()} == {k: len(range(k, 1000, 7)) for k in range(7)}


def test_dropped_and_passing_tables_are_gone(spark):
    before = tables(spark)
    kept, gone = materialize(spark.range(3)), materialize(spark.range(3))
    drop(gone, None, spark.range(3))
    assert len(tables(spark) - before) == 1 and kept.count() == 3
    with passing_tables():
        materialize(spark.range(3))
        with pytest.raises(ZeroDivisionError), passing_tables():
            materialize(spark.range(3))
            raise ZeroDivisionError
        with passing_tables() as keep:
            found = keep(materialize(spark.range(4)))
            materialize(spark.range(3))
        assert found.count() == 4 and len(tables(spark) - before) == 3
    assert len(tables(spark) - before) == 1
    drop(kept)


def test_rounds_of_a_dual_fit_do_not_pile_up(spark, vectors, monkeypatch):
    monkeypatch.setattr(dual, "BLOCK_DOCS", 20)
    left = []
    for rounds in (2, 6):
        before = tables(spark)
        counted = vectors.select(F.explode(F.col("indices").cast("array<long>")).alias("idx")).groupBy("idx").agg(F.count("*").alias("entries"))
        words = materialize(counted.select("idx", F.lit(2).cast("long").alias("df"), F.lit(None).cast("array<int>").alias("counts"), "entries"))
        packed = [
            (r["doc_id"], *dual._packed_doc(r["doc_id"], 1.0 if r["class"] == "pos" else -1.0, -1, np.array(r["indices"], np.int64), np.array(r["values"])))
            for r in vectors.collect()
        ]
        fitted = dual.fit_blocks(spark.createDataFrame(packed, dual.PACKED), words, 60, [dual.Margin()], gap=0.0, max_rounds=rounds)
        left.append(len(tables(spark) - before))
        assert fitted.progress.rounds == rounds - 1 and fitted.weights().count() > 1
    assert left == [3, 3]


def test_an_svd_keeps_its_vectors_only(spark, vectors):
    before = tables(spark)
    found = reduction.fit_svd(vectors, 3)
    assert len(tables(spark) - before) == 1
    assert found.reduce(vectors).count() == 60


def test_epochs_do_not_pile_up(spark, vectors, monkeypatch):
    monkeypatch.setattr(sgd, "BLOCK_DOCS", 20)
    before = tables(spark)
    found = sgd.fit_sgd(vectors, "pos", max_epochs=4)
    assert len(tables(spark) - before) == 1 and found.weights.count() > 0


def test_a_forest_keeps_its_trees_only(spark, reviews):
    rows = spark.createDataFrame([(r["doc_id"], r["class"], [{"term": w, "tf": 1} for w in sorted(set(r["text"].split()))]) for r in reviews.collect()], "doc_id long, class string, terms array<struct<term: string, tf: int>>")
    before = tables(spark)
    model = fit_classifier(rows, ClassifierSettings("decisiontree"))
    # Splits, subtrees and the vocabulary.
    assert len(tables(spark) - before) == 3
    assert model.predict(rows).count() == rows.count()


def test_a_search_leaves_no_tables(spark, reviews):
    before = tables(spark)
    log = search.run_search(reviews, search.parameter_grid({"classifier": ["complementnb"], "max_df": [0.5, 0.8], "min_df": [1]}), k=3)
    assert log.where("f1_weighted is not null").count() == 2
    assert tables(spark) == before


def test_terms_of_one_document_travel_without_folds(spark, reviews, monkeypatch):
    """Out-of-fold Naive Bayes: no row of sums or of the model for a term of a single document, and the same predictions as a
    fit for each fold."""
    rows = reviews.collect()
    docs = [(r["doc_id"], r["class"], i % 3, [{"term": t, "tf": 1 + i % 2} for t in sorted({*r["text"].split(), f"only{i}", "all" if i else "none"})]) for i, r in enumerate(rows)]
    terms = spark.createDataFrame(docs, "doc_id long, class string, fold int, terms array<struct<term: string, tf: int>>")
    seen, write = [], evaluation.materialize
    monkeypatch.setattr(evaluation, "materialize", lambda df: seen.append(write(df)) or seen[-1])
    monkeypatch.setattr(evaluation, "drop", lambda *tables: None)
    for kind, max_df, min_df in (("complement", 0.5, 1), ("multinomial", 0.9, 1), ("complement", 0.9, 2)):
        seen.clear()
        found = evaluation.out_of_fold_naive_bayes(terms, 3, kind, 1.0, max_df, min_df).collect()
        assert not [r["term"] for table in seen for r in table.select("term").collect() if (r["term"] or "").startswith(("only", "none"))]
        expected = {}
        for f in range(3):
            model = naive_bayes.fit_naive_bayes(terms.where(F.col("fold") != f), kind, 1.0, max_df, min_df)
            expected |= {r["doc_id"]: r["predicted"] for r in model.predict(terms.where(F.col("fold") == f).drop("class")).collect()}
        assert {r["doc_id"]: r["predicted"] for r in found} == expected


def test_naive_bayes_writes_blocks_and_model_only(spark, reviews, monkeypatch):
    """The terms are written once, as blocks, which go with the fit; small blocks give the same sums."""
    rows = [(r["doc_id"], r["class"], [{"term": t, "tf": 2} for t in sorted(set(r["text"].split()))]) for r in reviews.collect()]
    terms = spark.createDataFrame(rows, "doc_id long, class string, terms array<struct<term: string, tf: int>>")
    found = []
    for entries in (1 << 19, 25):
        monkeypatch.setattr(term_blocks, "BLOCK_ENTRIES", entries)
        for kind in naive_bayes.KINDS:
            before = tables(spark)
            model = naive_bayes.fit_naive_bayes(terms, kind, 1.0, 0.9, 2, 9)
            assert len(tables(spark) - before) == 1
            found.append({r["term"]: r.asDict() for r in model.terms.collect()})
    for one, other in zip(found[:3], found[3:]):
        assert len(one) == 9 and one.keys() == other.keys()
        assert all(one[t][c] == pytest.approx(other[t][c], rel=1e-9) for t in one for c in one[t] if c != "term")


def test_a_query_keeps_no_terms_of_the_fit(spark):
    """What stays is the vocabulary, the weights and the blocks of the texts to predict."""
    before = tables(spark)
    found = catalog.queries()["linear_svm_predict"](spark, "/root/testdata/sf0.001")
    assert len(tables(spark) - before) == 3 and found.count() > 0


def test_a_dual_block_is_read_in_batches_and_small():
    """Messages come a batch at a time, in any order; a block takes less than 55 bytes an entry while it is put together."""
    deal, rows = np.random.default_rng(1), []
    for i in range(2000):
        names = np.unique(deal.integers(0, 100_000, 300))
        rows.append((7, "doc", i, dual._packed_doc(i, 1.0 if i % 3 else -1.0, -1, names, deal.random(len(names)))[1], None))
    frame = pd.DataFrame(rows, columns=["target", "kind", "source", "payload", "numbers"])
    found = []
    for order in (range(0, 2000, 100), range(1900, -1, -100)):
        tracemalloc.start()
        block, weights, spread, target = dual._answered((frame[a : a + 100] for a in order), [dual.Margin()], dual.Vectoriser(), (8, 1))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 55 * len(block.values) and target == 7 and block.ids.tolist() == list(range(2000))
        dual.ascend(block, weights, spread, [dual.Margin()], 2, 3, None)
        found.append(weights)
    assert (found[0] == found[1]).all() and dual.BLOCK_ENTRIES <= 1 << 24
