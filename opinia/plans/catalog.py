"""The query catalogue: every entry reads the tables of a data folder and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinia.functions.fixed_values import EMOJI_STAND_INS
from opinia.functions.stop_words import stop_word_list, stop_words_frame
from opinia.functions.text import LEGACY, TokenizerConfig
from opinia.operators import (
    classifiers,
    evaluation,
    explore,
    features,
    naive_bayes,
    reduction,
    scaling,
    selection,
    term_blocks,
    terms,
)
from opinia.operators.materialize import checkpoint_folder, drop, materialize, passing_tables
from opinia.plans import search, training
from opinia.plans.parameters import GIVEN_WORDS, GRID
from opinia.sources.readers import corpus, labelled, read_development_csv, read_evaluation_csv, table, unlabelled
from opinia.sources.writers import prediction_export, write_experiment_log, write_itemsets_csv, write_reviews_csv

Query = Callable[[SparkSession, str], DataFrame]
BOTH = (1, 2)


def _flat(tokens: DataFrame) -> DataFrame:
    return tokens.withColumn("tokens", F.array_join("tokens", " "))


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def with_emoji(docs: DataFrame) -> DataFrame:
    """The fixtures hold no emoji, so some of their frequent words are turned into emoji."""
    text = F.col("text")
    for word, emoji in EMOJI_STAND_INS:
        text = F.replace(text, F.lit(word), F.lit(emoji))
    return docs.withColumn("text", text)


def _dev_terms(spark: SparkSession, folder: str, ngram_range: tuple[int, int] = BOTH) -> DataFrame:
    return terms.doc_terms(terms.tokenize(labelled(spark, folder)), ngram_range)


def _eva_terms(spark: SparkSession, folder: str, ngram_range: tuple[int, int] = BOTH) -> DataFrame:
    return terms.doc_terms(terms.tokenize(unlabelled(spark, folder)), ngram_range)


def _n_labelled(spark: SparkSession, folder: str) -> int:
    return table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id", "left_semi").count()


def _dev_blocks(spark: SparkSession, folder: str, ngram_range: tuple[int, int] = BOTH) -> tuple[DataFrame, list, DataFrame, int]:
    """The labelled texts in blocks, their other columns, the vocabulary with idf and the number of texts."""
    # Vocabulary and vectors read the blocks: tokenised and written once.
    counted, n = _dev_terms(spark, folder, ngram_range), _n_labelled(spark, folder)
    blocks = term_blocks.packed(counted)
    words = term_blocks.counted_terms(blocks).where(terms.within_limits(F.col("df"), n, 1, 0.5))
    return blocks, term_blocks.other_fields(counted), terms.with_idf(words, n), n


def _dev_vectors(spark: SparkSession, folder: str, ngram_range: tuple[int, int] = BOTH) -> tuple[DataFrame, int]:
    blocks, fields, words, n = _dev_blocks(spark, folder, ngram_range)
    return term_blocks.weighed_blocks(blocks, fields, words), n


def class_counts(spark, folder):
    return explore.class_counts(labelled(spark, folder))


def evaluation_counts(spark, folder):
    return unlabelled(spark, folder).agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("characters"))


def doc_length_hist(spark, folder):
    return _rounded(_rounded(explore.length_histogram(labelled(spark, folder)), "lower", "upper"), "density", digits=9)


def doc_length_stats(spark, folder):
    return _rounded(explore.length_statistics(labelled(spark, folder)), "mean", "std")


def doc_length_box(spark, folder):
    return explore.length_boxes(labelled(spark, folder))


def tokens_clean(spark, folder):
    return _flat(terms.tokenize(corpus(spark, folder)).withColumn("n", F.size("tokens")))


def tokens_all_stop_words(spark, folder):
    return _flat(terms.tokenize(corpus(spark, folder), TokenizerConfig(keep_listed_words=False)))


def tokens_legacy(spark, folder):
    return _flat(terms.tokenize(corpus(spark, folder), LEGACY))


def emoji_tokens(spark, folder):
    return _flat(terms.tokenize(with_emoji(corpus(spark, folder))))


def stop_word_occurrences(spark, folder):
    counts = terms.word_counts(terms.tokenize(corpus(spark, folder), TokenizerConfig(drop_stop_words=False)))
    # A few hundred stop words, whatever the corpus.
    words = F.broadcast(stop_words_frame(spark, keep_listed=True))
    found = counts.join(words, "word", "left_semi")
    return words.join(found, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


def legacy_word_set(spark, folder):
    return explore.legacy_word_set(corpus(spark, folder))


def top_words(spark, folder):
    return explore.top_words(labelled(spark, folder), 30)


def top_words_by_class(spark, folder):
    return _rounded(explore.top_words_by_class(labelled(spark, folder), 30), "neg_rate", "pos_rate")


def given_word_df(spark, folder):
    return explore.given_word_counts(labelled(spark, folder), GIVEN_WORDS)


def emoji_by_class(spark, folder):
    return _rounded(explore.emoji_by_class(with_emoji(labelled(spark, folder))), "neg_rate", "pos_rate")


def frequent_itemsets(spark, folder):
    sets = explore.frequent_itemsets(corpus(spark, folder), 0.2)
    return _rounded(sets.withColumn("items", F.array_join("items", ",")), "support")


def random_reviews(spark, folder):
    return _flat(explore.shuffled_listing(corpus(spark, folder), seed=7))


def ngram_counts(spark, folder):
    return terms.document_frequency(terms.doc_terms(terms.tokenize(corpus(spark, folder)), BOTH))


def df_pruned_vocab(spark, folder):
    return terms.vocabulary(_dev_terms(spark, folder), _n_labelled(spark, folder), 0.5, 2).select("term", "df")


def max_features_vocab(spark, folder):
    return terms.vocabulary(_dev_terms(spark, folder), _n_labelled(spark, folder), 0.5, 2, max_features=500)


def vocabulary_size(spark, folder):
    words = terms.vocabulary(_dev_terms(spark, folder), _n_labelled(spark, folder), 0.5, 1)
    return words.agg(F.count("*").alias("n"))


def tfidf_weights(spark, folder):
    return _rounded(terms.weight_rows(_dev_vectors(spark, folder)[0]), "w")


def _scaled(scaler: str) -> Query:
    def query(spark, folder):
        blocks, fields, words, n = _dev_blocks(spark, folder)
        return _rounded(scaling.scale_blocks(blocks, fields, words, scaler, n).select("doc_id", "term", "w"), "w")

    return query


def chi2_top_terms(spark, folder):
    vectors, n = _dev_vectors(spark, folder)
    shares = {c: m / n for c, m in naive_bayes.class_sizes(labelled(spark, folder)).items()}
    return _rounded(selection.chi2_top_terms(vectors, shares, 10_000), "chi2")


def _naive_bayes(kind: str) -> Query:
    def query(spark, folder):
        model = naive_bayes.fit_naive_bayes(_dev_terms(spark, folder), kind)
        predicted = model.predict(_eva_terms(spark, folder))
        return predicted.drop("score") if kind == "gaussian" else _rounded(predicted, "score")

    return query


cnb_predict = _naive_bayes("complement")


def _classifier(**settings) -> Query:
    """Fit on the labelled texts, predict the others."""

    def query(spark, folder):
        known = materialize(_dev_terms(spark, folder))
        fitted = classifiers.fit_classifier(known, classifiers.ClassifierSettings(**settings))
        # Models read what the fit has written of the texts, if anything.
        drop(known)
        return fitted.predict(_eva_terms(spark, folder)).select("doc_id", "predicted")

    return query


COMPONENTS = 400


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Unit TF-IDF rows of the labelled texts."""
    with passing_tables() as keep:
        counted = materialize(_dev_terms(spark, folder))
        return keep(materialize(features.sparse_rows(counted, features.fit_vectoriser(counted, 0.5, 2))))


def lsa_features(spark, folder):
    """Labelled texts on their 400 leading singular vectors, brought to length one. Signs are arbitrary."""
    rows = _vectors(spark, folder)
    reduced = reduction.fit_svd(rows, COMPONENTS).reduce(rows)
    # In tiles by now.
    drop(rows)
    length = F.sqrt(F.aggregate("reduced", F.lit(0.0), lambda total, x: total + x * x))
    unit = F.transform("reduced", lambda x: F.when(F.col("length") > 0, x / F.col("length")).otherwise(0.0))
    return reduced.withColumn("length", length).select("doc_id", unit.alias("reduced"))


def singular_values(spark, folder):
    """The 400 largest singular values of the labelled texts' TF-IDF matrix."""
    with passing_tables():
        values = reduction.fit_svd(_vectors(spark, folder), COMPONENTS).values
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "component int, value double")


def pca_features(spark, folder):
    """Labelled texts on their 400 principal axes, over the whole vocabulary."""
    rows = _vectors(spark, folder)
    reduced = reduction.fit_pca(rows, COMPONENTS).reduce(rows)
    drop(rows)
    return reduced


def feature_importances(spark, folder):
    settings = classifiers.ClassifierSettings("randomforest")
    forest = classifiers.fit_classifier(materialize(_dev_terms(spark, folder, (1, 1))), settings)
    return classifiers.feature_importances(forest, 30)


def stemmed_vocab(spark, folder):
    return terms.stemmed_vocabulary(terms.tokenize(corpus(spark, folder)))


def tokens_stemmed(spark, folder):
    return _flat(terms.tokenize(corpus(spark, folder), TokenizerConfig(stemmer=True)))


def scored_export(spark, folder):
    return prediction_export(cnb_predict(spark, folder))


def stratified_folds(spark, folder):
    return evaluation.stratified_folds(labelled(spark, folder))


def _dev_terms_with_folds(spark: SparkSession, folder: str) -> DataFrame:
    return training.prepare_folds(labelled(spark, folder), training.TextSettings(TokenizerConfig(), BOTH))


def fold_idf(spark, folder):
    return _rounded(evaluation.fold_idf(_dev_terms_with_folds(spark, folder), 10), "idf")


def oof_predictions(spark, folder):
    return evaluation.out_of_fold_naive_bayes(_dev_terms_with_folds(spark, folder), spent=True)


def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(oof_predictions(spark, folder))


def fold_f1_weighted(spark, folder):
    return _rounded(evaluation.weighted_f1(oof_predictions(spark, folder), ["fold"]), "f1_weighted")


def cv_f1_weighted(spark, folder):
    return _rounded(evaluation.cross_validation_score(oof_predictions(spark, folder)), "f1_weighted")


def grid_search(spark, folder):
    params = {
        "classifier": list(dict.fromkeys(f"{kind}nb" for kind, _, _ in GRID)),
        "max_df": list(dict.fromkeys(max_df for _, max_df, _ in GRID)),
        "min_df": list(dict.fromkeys(min_df for _, _, min_df in GRID)),
        "ngram_range": [BOTH],
    }
    log = search.run_search(labelled(spark, folder), search.parameter_grid(params))
    return _rounded(log.select("config_id", "classifier", "max_df", "min_df", "f1_weighted"), "f1_weighted")


def best_config(spark, folder):
    return search.best_configuration(grid_search(spark, folder))


def param_grid(spark, folder):
    """The grid that is searched by default, one row per configuration, with the number of labelled texts it is for."""
    rows = [(i, c.C, *c.ngram_range, c.loss, c.max_df, float(c.min_df), c.tol) for i, c in enumerate(search.parameter_grid(search.DEFAULT_GRID))]
    grid = spark.createDataFrame(rows, "config_id int, C double, ngram_1 int, ngram_2 int, loss string, max_df double, min_df double, tol double")
    # One row on either side of a lookup by a constant.
    return grid.join(F.broadcast(labelled(spark, folder).agg(F.count("*").alias("texts"))))


def active_pipeline_export(spark, folder):
    """Stems, one- and two-word terms, hinge SVM with C = 3, predictions numbered for export."""
    text, settings = training.TextSettings(), classifiers.ClassifierSettings(loss="hinge", C=3.0, tol=1e-8, min_df=1)
    known = materialize(training.prepare_terms(labelled(spark, folder), text))
    model = classifiers.fit_classifier(known, settings)
    drop(known)
    predicted = model.predict(training.prepare_terms(unlabelled(spark, folder), text))
    return prediction_export(predicted.select("doc_id", "predicted"))


def svm_grid_search(spark, folder):
    """The whole default grid, 24 configurations in ten folds."""
    return search.run_search(labelled(spark, folder), search.parameter_grid(search.DEFAULT_GRID))


def _active_out_of_fold(spark: SparkSession, folder: str) -> DataFrame:
    """The active pipeline's predictions of the labelled texts, each by the fold that held it out."""
    folds = training.prepare_folds(labelled(spark, folder), training.TextSettings())
    return training.out_of_fold(folds, classifiers.ClassifierSettings(loss="hinge", C=3.0, tol=1e-8, min_df=1))


def active_cv_f1(spark, folder):
    return _rounded(evaluation.cross_validation_score(_active_out_of_fold(spark, folder)), "f1_weighted")


def active_confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(_active_out_of_fold(spark, folder))


def _sink(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which driver and executors share."""
    return f"{checkpoint_folder(spark)}/sink-{uuid.uuid4().hex}"


def development_csv(spark, folder):
    """The labelled texts written as CSV and read back."""
    path = _sink(spark)
    write_reviews_csv(labelled(spark, folder), path)
    return read_development_csv(spark, path).select("doc_id", "text", "class")


def evaluation_csv(spark, folder):
    path = _sink(spark)
    write_reviews_csv(unlabelled(spark, folder), path)
    return read_evaluation_csv(spark, path).select("doc_id", "text")


def itemset_sink(spark, folder):
    """Frequent itemsets written as CSV and read back."""
    path = _sink(spark)
    write_itemsets_csv(explore.frequent_itemsets(corpus(spark, folder), 0.2), path)
    return _rounded(spark.read.csv(path, schema="support double, itemsets string", header=True), "support")


def experiment_log_sink(spark, folder):
    """The log of a search, appended configuration by configuration, and read back."""
    path, log = _sink(spark), materialize(grid_search(spark, folder))
    for i, (kind, max_df, min_df) in enumerate(GRID):
        write_experiment_log(log.where(F.col("config_id") == i), path, append=i > 0)
    schema = "CONFIG_ID int, CLASSIFIER string, MAX_DF double, MIN_DF double, F1_WEIGHTED double"
    return _rounded(spark.read.csv(path, schema=schema, header=True), "F1_WEIGHTED")


def tokens_second_removal(spark, folder):
    """Tokens without the listed stop words, then without all of them."""
    return _flat(terms.drop_words(terms.tokenize(corpus(spark, folder)), stop_word_list()))


def queries() -> dict[str, Query]:
    return {
        "class_counts": class_counts,
        "evaluation_counts": evaluation_counts,
        "doc_length_hist": doc_length_hist,
        "doc_length_stats": doc_length_stats,
        "doc_length_box": doc_length_box,
        "tokens_clean": tokens_clean,
        "tokens_all_stop_words": tokens_all_stop_words,
        "tokens_legacy": tokens_legacy,
        "emoji_tokens": emoji_tokens,
        "stop_word_occurrences": stop_word_occurrences,
        "legacy_word_set": legacy_word_set,
        "top_words": top_words,
        "top_words_by_class": top_words_by_class,
        "given_word_df": given_word_df,
        "emoji_by_class": emoji_by_class,
        "frequent_itemsets": frequent_itemsets,
        "random_reviews": random_reviews,
        "ngram_counts": ngram_counts,
        "df_pruned_vocab": df_pruned_vocab,
        "max_features_vocab": max_features_vocab,
        "vocabulary_size": vocabulary_size,
        "tfidf_weights": tfidf_weights,
        "maxabs_scaled": _scaled("maxabs"),
        "minmax_scaled": _scaled("minmax"),
        "standard_scaled": _scaled("standard"),
        "robust_scaled": _scaled("robust"),
        "chi2_top_terms": chi2_top_terms,
        "mnb_predict": _naive_bayes("multinomial"),
        "cnb_predict": cnb_predict,
        "gnb_predict": _naive_bayes("gaussian"),
        "knn_predict": _classifier(classifier="knn", min_df=1),
        "linear_svm_predict": _classifier(classifier="linearsvc", loss="hinge", C=3.0, tol=1e-8, min_df=1),
        "squared_hinge_svm_predict": _classifier(classifier="linearsvc", loss="squared_hinge", C=3.0),
        "l1_svm_predict": _classifier(classifier="linearsvc", loss="squared_hinge", penalty="l1", C=3.0),
        "sgd_svm_predict": _classifier(classifier="sgd"),
        "random_forest_predict": _classifier(classifier="randomforest"),
        "decision_tree_predict": _classifier(classifier="decisiontree"),
        "lsa_features": lsa_features,
        "singular_values": singular_values,
        "pca_features": pca_features,
        "feature_importances": feature_importances,
        "stemmed_vocab": stemmed_vocab,
        "tokens_stemmed": tokens_stemmed,
        "scored_export": scored_export,
        "stratified_folds": stratified_folds,
        "fold_idf": fold_idf,
        "oof_predictions": oof_predictions,
        "confusion_matrix": confusion_matrix,
        "fold_f1_weighted": fold_f1_weighted,
        "cv_f1_weighted": cv_f1_weighted,
        "grid_search": grid_search,
        "best_config": best_config,
        "param_grid": param_grid,
        "active_pipeline_export": active_pipeline_export,
        "svm_grid_search": svm_grid_search,
        "development_csv": development_csv,
        "evaluation_csv": evaluation_csv,
        "itemset_sink": itemset_sink,
        "experiment_log_sink": experiment_log_sink,
        "tokens_second_removal": tokens_second_removal,
        "active_cv_f1": active_cv_f1,
        "active_confusion_matrix": active_confusion_matrix,
    }
