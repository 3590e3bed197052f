"""From texts to tokens, term counts, vocabularies and TF-IDF vectors.

Frames: docs(doc_id, text, ...), tokens(doc_id, ..., tokens), doc_terms(doc_id, ..., terms array<(term, tf)>),
vocabulary(term, df, cf), vectors(doc_id, ..., weights array<(term, w)>). A document stays one row until something has
to be known per term, so tokens and term counts cost no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinia.functions.stemming import stem_words
from opinia.functions.text import (
    TokenizerConfig,
    ngrams,
    plain_text,
    replace_emoji,
    run_lengths,
    run_starts,
    split_tokens,
)
from opinia.operators.lookup import HOT_TERMS
from opinia.operators.term_blocks import swapped_tokens, tfidf_rows

# Terms that a summary holds: its counts are short by less than 3.5 / HELD_TERMS of the rows.
HELD_TERMS = 4 * HOT_TERMS
# Summaries are merged in so many groups before all meet.
MERGED_FIRST = 64


def unfold(df: DataFrame, array: str, output: str) -> DataFrame:
    """One row per element of an array column of non-null elements.

    The outer form with a filter behind it is deliberate: for a plain explode Spark infers a filter on the array's
    size and pushes it below the projections that compute the array, which would compute everything twice.
    """
    kept = [c for c in df.columns if c != array]
    return df.select(*kept, F.explode_outer(array).alias(output)).where(F.col(output).isNotNull())


def tokenize(docs: DataFrame, config: TokenizerConfig = TokenizerConfig()) -> DataFrame:
    """Replace ``text`` by ``tokens``."""
    kept = [F.col(c) for c in docs.columns if c != "text"]
    df = docs.select(*kept, plain_text(F.col("text"), config).alias("_text"))
    df = df.select(*kept, replace_emoji(F.col("_text"), config).alias("_text"))
    df = df.select(*kept, split_tokens(F.col("_text"), config).alias("tokens"))
    return stem_tokens(df) if config.stemmer else df


def word_counts(tokens: DataFrame) -> DataFrame:
    """(word, n): distinct tokens of the corpus with their number of occurrences."""
    return unfold(tokens.select("tokens"), "tokens", "word").groupBy("word").agg(F.count("*").alias("n"))


def stemmed_vocabulary(tokens: DataFrame) -> DataFrame:
    """(word, n, stem): every distinct word is stemmed once."""
    return stem_words(word_counts(tokens))


def stem_tokens(tokens: DataFrame) -> DataFrame:
    """Swap every token for its stem, keeping order and repeats. Blocks of documents ask once for each of their words."""
    return swapped_tokens(tokens, stem_words)


def drop_words(tokens: DataFrame, words: list[str]) -> DataFrame:
    """A second stop-word removal on finished tokens (after stemming), before n-grams are built."""
    return tokens.withColumn("tokens", F.filter("tokens", lambda word: ~word.isin(words)))


def doc_terms(tokens: DataFrame, ngram_range: tuple[int, int] = (1, 1)) -> DataFrame:
    """tokens -> terms: distinct n-grams of each document with their counts, computed inside the row."""
    kept = [c for c in tokens.columns if c != "tokens"]
    df = tokens.select(*kept, F.sort_array(ngrams(F.col("tokens"), *ngram_range)).alias("_grams"))
    df = df.select(*kept, "_grams", run_starts(F.col("_grams")).alias("_starts"))
    return df.select(*kept, run_lengths(F.col("_grams"), F.col("_starts")).alias("terms"))


def term_rows(terms: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per document and term; with ``keep_empty`` also one (term null) per document without terms."""
    kept = [c for c in terms.columns if c != "terms"]
    # Outer on purpose, see ``unfold``.
    rows = terms.select(*kept, F.inline_outer("terms"))
    return rows if keep_empty else rows.where(F.col("term").isNotNull())


def document_frequency(terms: DataFrame, **counts: Column) -> DataFrame:
    """(term, df, cf, ...): documents and occurrences per term, plus further aggregates by name."""
    extra = [column.alias(name) for name, column in counts.items()]
    return term_rows(terms).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"), *extra)


def frequent_terms(terms: DataFrame) -> DataFrame:
    """(term): the most frequent terms of these documents, whether a vocabulary keeps them or not.

    Comes from mergeable summaries of fixed size, one for each task, so no term is shuffled. A summary of that size holds
    every term with a 1/HOT_TERMS of the rows for certain.
    """
    rows = term_rows(terms.select("terms")).select("term", F.pmod(F.spark_partition_id(), F.lit(MERGED_FIRST)).alias("_part"))
    some = rows.groupBy("_part").agg(F.expr(f"approx_top_k_accumulate(term, {HELD_TERMS})").alias("summary"))
    whole = some.agg(F.expr("approx_top_k_combine(summary)").alias("summary"))
    return whole.select(F.expr(f"inline(approx_top_k_estimate(summary, {HOT_TERMS}))")).select(F.col("item").alias("term"))


def within_limits(df: Column, n_docs: Column | int, min_df: float, max_df: float) -> Column:
    """Document-frequency limits: integers are counts, floats are shares of the documents."""
    most = F.lit(max_df) * n_docs if isinstance(max_df, float) else F.lit(max_df)
    least = F.lit(min_df) * n_docs if isinstance(min_df, float) else F.lit(min_df)
    return (df <= most) & (df >= least)


def vocabulary(
    terms: DataFrame,
    n_docs: int,
    max_df: float = 1.0,
    min_df: float = 1,
    max_features: int | None = None,
) -> DataFrame:
    """(term, df, cf) within the limits; with ``max_features`` only the most frequent ones."""
    return limited(document_frequency(terms), n_docs, max_df, min_df, max_features)


def limited(words: DataFrame, n_docs: int, max_df: float = 1.0, min_df: float = 1, max_features: int | None = None) -> DataFrame:
    """(term, df, cf) within the limits, of all terms."""
    words = words.where(within_limits(F.col("df"), n_docs, min_df, max_df))
    return words if max_features is None else words.orderBy(F.desc("cf"), "term").limit(max_features)


def with_idf(words: DataFrame, n_docs: int) -> DataFrame:
    """Add the smoothed inverse document frequency ln((1+n)/(1+df)) + 1."""
    return words.withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.col("df") + 1)) + 1)


def tfidf_vectors(terms: DataFrame, words: DataFrame, name: str = "term") -> DataFrame:
    """doc_terms x vocabulary with idf -> vectors of unit length. Documents without known terms keep an empty one.

    ``name`` is the vocabulary's column that names a feature in the vectors: the term itself or its number. Where the
    vocabulary has columns scale and shift, they are applied to the unit vectors.
    """
    return tfidf_rows(terms, words, name)


def weight_rows(vectors: DataFrame) -> DataFrame:
    """One row per document and term with its weight."""
    kept = [c for c in vectors.columns if c != "weights"]
    return vectors.select(*kept, F.inline_outer("weights")).where(F.col("w").isNotNull())
