"""Exploration tables: class sizes, text lengths, frequent words, emoji, itemsets, a random listing."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.functions import fixed_values as fixed
from opinia.functions.text import LEGACY, TokenizerConfig
from opinia.operators.materialize import materialize
from opinia.operators.terms import tokenize, unfold

NEGATIVE, POSITIVE = "neg", "pos"
OVERALL = "overall"
# Bits set in a byte.
ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def class_counts(docs: DataFrame) -> DataFrame:
    """(class, n): each class and the whole."""
    return (
        docs.select("class").rollup("class").agg(F.count("*").alias("n"))
        .select(F.coalesce("class", F.lit(OVERALL)).alias("class"), "n")
    )


def length_counts(docs: DataFrame, *by: str) -> DataFrame:
    """(..., length, n): how many texts have each length. All length statistics start from this small table."""
    return docs.select(*by, F.length(F.coalesce("text", F.lit(""))).alias("length")).groupBy(*by, "length").agg(
        F.count("*").alias("n")
    )


def length_statistics(docs: DataFrame) -> DataFrame:
    """Mean, population standard deviation and median of the text length."""
    length = F.length(F.coalesce("text", F.lit("")))
    return docs.agg(
        F.count("*").alias("n"),
        F.avg(length).alias("mean"),
        F.stddev_pop(length).alias("std"),
        F.percentile(length, 0.5).alias("median"),
    )


def length_histogram(docs: DataFrame, bins: int = 50) -> DataFrame:
    """(bin, lower, upper, n, density): equal bins from the shortest to the longest text. The last one holds its
    upper edge; the densities times the bin width add up to 1."""
    counts = length_counts(docs)
    span = counts.agg(F.min("length").alias("lo"), F.max("length").alias("hi"), F.sum("n").alias("total"))
    # A single length gets a span of one around it.
    flat = F.col("lo") == F.col("hi")
    span = span.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo").cast("double")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi").cast("double")).alias("hi"),
        "total",
    )
    width = (F.col("hi") - F.col("lo")) / bins
    edges = span.select("lo", "hi", "total", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")).select(
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("lower"),
        F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        "total",
        width.alias("width"),
    )
    # The bin by arithmetic, put right where rounding lands on the wrong side of an edge; the joins meet one or 50 rows.
    lower = lambda bin_: F.col("lo") + bin_ * F.col("width")
    placed = counts.join(F.broadcast(span.select("lo", width.alias("width"))), how="cross")
    guess = F.floor((F.col("length") - F.col("lo")) / F.col("width"))
    guess = guess + F.when(F.col("length") < lower(guess), -1).when(F.col("length") >= lower(guess + 1), 1).otherwise(0)
    binned = placed.select(F.least(F.lit(bins - 1), guess).cast("int").alias("bin"), "n").groupBy("bin").agg(F.sum("n").alias("n"))
    return edges.join(binned, "bin", "left").select(
        "bin", "lower", "upper", F.coalesce("n", F.lit(0)).alias("n"),
        (F.coalesce("n", F.lit(0)) / (F.col("total") * F.col("width"))).alias("density"),
    )


def length_boxes(docs: DataFrame) -> DataFrame:
    """Box statistics of the text length, overall and by class. Whiskers end at the furthest text within 1.5 times
    the box height, never inside the box."""
    counts = length_counts(docs, "class")
    both = F.explode(F.array(F.lit(OVERALL), F.col("class")))
    counts = counts.select(both.alias("group"), "length", "n").groupBy("group", "length").agg(F.sum("n").alias("n"))
    quartiles = counts.groupBy("group").agg(
        F.percentile("length", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q")
    )
    boxes = quartiles.select(
        "group", *[F.col("q")[i].alias(name) for i, name in enumerate(["q1", "median", "q3"])]
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("length").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        counts.join(boxes, "group")
        .groupBy("group", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("length"))).alias("_low"),
            F.max(F.when(inside, F.col("length"))).alias("_high"),
        )
        .select(
            "group", "q1", "median", "q3",
            F.least(F.col("_low").cast("double"), "q1").alias("whisker_low"),
            F.greatest(F.col("_high").cast("double"), "q3").alias("whisker_high"),
        )
    )


def _words_by_document(docs: DataFrame, config: TokenizerConfig) -> DataFrame:
    kept = [c for c in docs.columns if c != "text"]
    return unfold(tokenize(docs, config).select(*kept, F.array_distinct("tokens").alias("_words")), "_words", "word")


def word_document_frequency(docs: DataFrame, config: TokenizerConfig = TokenizerConfig()) -> DataFrame:
    """(word, n): number of documents that hold the word."""
    return _words_by_document(docs.select("doc_id", "text"), config).groupBy("word").agg(F.count("*").alias("n"))


def top_words(docs: DataFrame, n: int = 10, config: TokenizerConfig = TokenizerConfig()) -> DataFrame:
    """The n words that most documents hold. Ties go to the alphabetically first."""
    return word_document_frequency(docs, config).orderBy(F.desc("n"), "word").limit(n)


def given_word_counts(docs: DataFrame, words: list[str], config: TokenizerConfig = TokenizerConfig()) -> DataFrame:
    """(position, word, neg, pos): documents of each class that hold the caller's words, in the caller's order;
    0 for a word that nowhere occurs."""
    spark = docs.sparkSession
    wanted = spark.createDataFrame(list(enumerate(words)), "position int, word string")
    found = (
        _words_by_document(docs.select("doc_id", "class", "text"), config)
        .where(F.col("word").isin(list(words)))
        .groupBy("word")
        .agg(*[F.count_if(F.col("class") == c).alias(c) for c in (NEGATIVE, POSITIVE)])
    )
    return wanted.join(found, "word", "left").select(
        "position", "word", *[F.coalesce(c, F.lit(0)).alias(c) for c in (NEGATIVE, POSITIVE)]
    )


def _rates(counts: DataFrame, docs: DataFrame, keep: list[str]) -> DataFrame:
    sizes = docs.agg(*[F.count_if(F.col("class") == c).alias(f"_{c}") for c in (NEGATIVE, POSITIVE)])
    # One row of class sizes, read as a scalar.
    return counts.select(
        *keep,
        *[F.col(c).alias(f"{c}_count") for c in (NEGATIVE, POSITIVE)],
        *[(F.col(c) / sizes.select(f"_{c}").scalar()).alias(f"{c}_rate") for c in (NEGATIVE, POSITIVE)],
    )


def top_words_by_class(docs: DataFrame, n: int = 30, config: TokenizerConfig = TokenizerConfig()) -> DataFrame:
    """The top words with the share of each class's documents that hold them, in one pass over the texts."""
    top = (
        _words_by_document(docs.select("doc_id", "class", "text"), config)
        .groupBy("word")
        .agg(
            F.count("*").alias("count"),
            *[F.count_if(F.col("class") == c).alias(c) for c in (NEGATIVE, POSITIVE)],
        )
        .orderBy(F.desc("count"), "word")
        .limit(n)
    )
    return _rates(top, docs, ["word", "count"])


def emoji_by_class(docs: DataFrame) -> DataFrame:
    """Every listed emoji (positive, negative, neutral) with the documents of each class that hold it."""
    lists = {
        "positive": fixed.POSITIVE_EMOJI,
        "negative": fixed.NEGATIVE_EMOJI,
        "neutral": fixed.NEUTRAL_EMOJI,
    }
    listed = docs.sparkSession.createDataFrame(
        [(kind, i, e) for kind, emoji in lists.items() for i, e in enumerate(emoji)],
        "kind string, position int, emoji string",
    )
    every = F.array(*[F.lit(e) for emoji in lists.values() for e in emoji])
    held = F.filter(every, lambda e: F.contains(F.col("text"), e))
    found = (
        docs.where(F.col("text").rlike(fixed.BEYOND_BMP_PATTERN))
        .select("class", F.explode(held).alias("emoji"))
        .groupBy("emoji")
        .agg(*[F.count_if(F.col("class") == c).alias(c) for c in (NEGATIVE, POSITIVE)])
    )
    # The list is fixed: a few dozen rows.
    counts = F.broadcast(listed).join(found, "emoji", "left").select(
        "kind", "position", "emoji", *[F.coalesce(c, F.lit(0)).alias(c) for c in (NEGATIVE, POSITIVE)]
    )
    return _rates(counts, docs, ["kind", "position", "emoji"])


def legacy_word_set(docs: DataFrame) -> DataFrame:
    """(word): distinct tokens of the legacy tokenizer."""
    return unfold(tokenize(docs.select("text"), LEGACY), "tokens", "word").distinct()


def transactions(docs: DataFrame, longer_than: int = 2) -> DataFrame:
    """(doc_id, items): distinct legacy tokens of each document that are longer than the limit."""
    tokens = tokenize(docs.select("doc_id", "text"), LEGACY)
    return tokens.select(
        "doc_id", F.array_distinct(F.filter("tokens", lambda w: F.length(w) > longer_than)).alias("items")
    )


def _larger_sets(sets: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Sets of one item more, of which all smaller ones are in the sorted list ``sets``."""
    known, out = set(sets), []
    by_start: dict[tuple[int, ...], list[int]] = {}
    for s in sets:
        by_start.setdefault(s[:-1], []).append(s[-1])
    for start, ends in by_start.items():
        for i, a in enumerate(ends):
            for b in ends[i + 1 :]:
                found = (*start, a, b)
                if all(found[:at] + found[at + 1 :] in known for at in range(len(start))):
                    out.append(found)
    return out


def _holders(blocks: DataFrame, sets: list[tuple[int, ...]]) -> DataFrame:
    """(place, n): how many transactions hold each set of the list. A task sends one row for each set."""
    shared = blocks.sparkSession.sparkContext.broadcast(sets)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted, totals = shared.value, np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for payload, items in zip(batch["bits"], batch["items"]):
                bits = np.frombuffer(payload, np.uint8).reshape(items, -1)
                start, held = None, None
                for place, found in enumerate(wanted):
                    if found[:-1] != start:
                        # Sets with the same start stand together.
                        start, held = found[:-1], np.bitwise_and.reduce(bits[list(found[:-1])], axis=0)
                    totals[place] += ONES[held & bits[found[-1]]].sum()
        yield pd.DataFrame({"place": np.arange(len(wanted)), "n": totals})

    return blocks.mapInPandas(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))


def frequent_itemsets(docs: DataFrame, min_support: float = 0.2, longer_than: int = 2) -> DataFrame:
    """(items, freq, support): all sets of words that a share of at least ``min_support`` of the documents holds.

    Level by level: a set can only be frequent if all its smaller sets are. Transactions are cut down to the frequent words
    and kept as one bit for each word, packed by some thousand documents; a level is a pass over these, and a task sends
    one number for each candidate, whatever it has read. The driver sees the frequent words, at most (words per document /
    min_support) of them, and the candidates and frequent sets, whose number follows from the support asked for, not from the number of documents.
    """
    spark, baskets = docs.sparkSession, transactions(docs, longer_than)
    n_docs = docs.count()
    least = math.ceil(min_support * n_docs)
    counted = unfold(baskets.select("items"), "items", "word").groupBy("word").agg(F.count("*").alias("n"))
    single = {r["word"]: r["n"] for r in counted.where(F.col("n") >= max(least, 1)).collect()}
    words = sorted(single)
    freq = {(i,): single[word] for i, word in enumerate(words)}
    if len(words) > 1:
        cut = baskets.select(F.filter("items", lambda w: w.isin(words)).alias("items"))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            value_set = pa.array(words)
            for batch in batches:
                lists = batch.column(0)
                starts = lists.offsets.to_numpy()
                held = np.zeros((len(words), batch.num_rows), bool)
                held[pc.index_in(lists.flatten(), value_set).to_numpy(), np.repeat(np.arange(batch.num_rows), np.diff(starts))] = True
                yield pa.RecordBatch.from_arrays([pa.array([np.packbits(held, axis=1).tobytes()], pa.binary()), pa.array([len(words)], pa.int32())], ["bits", "items"])

        blocks = materialize(cut.mapInArrow(pack, "bits binary, items int"))
        level = _larger_sets(sorted(freq))
        while level:
            found = {level[r["place"]]: r["n"] for r in _holders(blocks, level).where(F.col("n") >= max(least, 1)).collect()}
            freq |= found
            level = _larger_sets(sorted(found))
    rows = [([words[i] for i in items], n, n / n_docs) for items, n in freq.items()]
    return spark.createDataFrame(rows, "items array<string>, freq long, support double")


def shuffled_listing(docs: DataFrame, seed: int = 0) -> DataFrame:
    """All documents' tokens in random order. The order comes from a hash of seed and doc_id: unlike a random number
    per row it stays the same when a lost task is run again."""
    key = F.md5(F.concat_ws("-", F.lit(seed), F.col("doc_id")))
    tokens = tokenize(docs.select("doc_id", "text"), LEGACY)
    return tokens.select(key.alias("shuffle_key"), "doc_id", "tokens").orderBy("shuffle_key", "doc_id")
