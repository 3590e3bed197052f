"""Catalogue queries against their SQL equivalents on the smallest tables."""

import glob
import os

import duckdb
import pytest

from opinia.plans import catalog, oracle

FOLDER = "/root/testdata/sf0.001"
# The rest of the catalogue is compared the same way by the driver; these cover every kind of operator.
CHECKED = [
    "class_counts", "doc_length_box", "tokens_clean", "tokens_legacy", "stop_word_occurrences", "top_words_by_class",
    "emoji_by_class", "frequent_itemsets", "df_pruned_vocab", "tfidf_weights", "robust_scaled", "cnb_predict",
    "stratified_folds", "scored_export", "param_grid", "doc_length_hist", "maxabs_scaled", "knn_predict", "gnb_predict",
]


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_equivalent_has_a_query():
    assert set(oracle.oracle_sql()) <= set(catalog.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query(spark, duck, name):
    frame = catalog.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    relation = duck.sql(oracle.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    expected = relation.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    got = [tuple(r) for r in frame.select(*[f"`{c}`" for c in columns]).collect()]
    assert sorted(got) == sorted(expected)
