"""Language identification by prediction by partial matching over bytes.

Each language has a byte context tree up to ``ORDER`` bytes deep with frozen counts. The code length of a byte follows
from its longest known context: seen c times among n with q different followers it costs -log2(c / (n + q)); else the
escape -log2(q / (n + q)) is paid and the next shorter context decides, down to 1/256 for any byte. A text goes to the
language with the shortest exact code of all its bytes (lower-cased), ties to the first by name.

Frozen trees make the code length a function of the last bytes. So the trees of all languages become one table: a state
for every context known to any language, a row per state and byte, a column per language. Scoring a text is a few table
look-ups per byte in numpy, over blocks of bounded size. The table's size is bounded by the sample it is learned from:
about ``SAMPLE`` labelled documents of each language, chosen by a hash of doc_id, each read whole.

Null text and text without a letter are ``und`` with score 0, as is everything if nothing was learned. Rows without a
doc_id are neither held out nor learned from. Labels that are null teach nothing. Without usable labels nothing is learned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.llm.storage import whole_row

ORDER = 3
# Labelled documents to learn from, for each language: the bound of the model's sample.
SAMPLE = 400
# Contexts seen less often in all languages together are left to the next shorter one.
LEAST_SEEN = 3
HASH_RANGE = 1 << 32
BLOCK = 1 << 20
UNKNOWN = "und"
LEAST_SCORE = 0.5


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def sampled(docs: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(lang, text) to learn from: a language's rows are counted, and a share of them that comes to ``size`` is taken by a
    hash of doc_id. No language's rows have to meet."""
    usable = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    # One row per language, as many as the model has columns.
    counts = F.broadcast(usable.groupBy("lang").agg(F.count("*").alias("rows")))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(HASH_RANGE))
    return usable.join(counts, "lang").where(place * F.col("rows") < F.lit(size) * HASH_RANGE).select("lang", "text")


def context_counts(sample: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, size, gram, n): how often each run of 1 to order + 1 bytes occurs; ``gram`` holds its bytes as a number."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
                gram = np.zeros(len(data), np.int64)
                for size in range(1, min(order + 1, len(data)) + 1):
                    gram = (gram[:-1] << 8 | data[size - 1 :]) if size > 1 else data
                    grams, n = np.unique(gram, return_counts=True)
                    yield pd.DataFrame({"lang": lang, "size": size, "gram": grams, "n": n})

    rows = sample.mapInPandas(count, "lang string, size int, gram long, n long")
    return rows.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


@dataclass
class CodeTable:
    """Code lengths of all languages. ``symbol``: byte to symbol, 0 for bytes never seen; ``state``: last ``ORDER``
    symbols to state; ``bits``: row state * symbols + symbol, column language."""

    languages: list[str]
    symbol: np.ndarray
    state: np.ndarray
    bits: np.ndarray
    order: int

    def code_lengths(self, text: str) -> np.ndarray:
        """Bits that each language needs for the whole text."""
        data = text.lower().encode("utf-8", "surrogatepass")
        total, symbols = np.zeros(len(self.languages)), int(self.symbol.max()) + 1
        for at in range(0, len(data), BLOCK):
            lead = data[max(0, at - self.order) : at]
            coded = self.symbol[np.frombuffer(lead + data[at : at + BLOCK], np.uint8)]
            coded = np.concatenate([np.zeros(self.order - len(lead), coded.dtype), coded])
            n = len(coded) - self.order
            history = coded[:n].copy()
            for k in range(1, self.order):
                history *= symbols
                history += coded[k : k + n]
            rows = self.state[history] * symbols + coded[self.order :]
            total += np.take(self.bits, rows, axis=0).sum(axis=0, dtype=np.float64)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        bits = self.code_lengths(text)
        best = int(np.argmin(bits))
        return self.languages[best], float(1 / np.exp2(np.minimum(bits[best] - bits, 0)).sum())


def code_table(counts: pd.DataFrame, order: int = ORDER, least: int = LEAST_SEEN) -> CodeTable:
    """The frozen trees as one table."""
    if counts.empty:
        return CodeTable([], np.zeros(256, np.int64), np.zeros(1, np.int64), np.zeros((1, 0), np.float32), order)
    languages = sorted(counts["lang"].unique())
    lang = counts["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64)
    size, gram, n = (counts[c].to_numpy(np.int64) for c in ("size", "gram", "n"))
    symbol = np.zeros(256, np.int64)
    seen = np.unique(gram[size == 1])
    symbol[seen] = np.arange(1, len(seen) + 1)
    symbols = len(seen) + 1
    # Bytes become symbols, so that contexts index small arrays.
    code = np.zeros_like(gram)
    for k in range(order, -1, -1):
        code = np.where(size > k, code * symbols + symbol[gram >> (8 * k) & 255], code)
    shorter = np.zeros(1, np.int64)  # history of k symbols to state
    chance = np.full((1, symbols, len(languages)), 1 / 256)
    states = 0
    levels = []
    for k in range(order + 1):
        at = size == k + 1
        context, follower = code[at] // symbols, code[at] % symbols
        known, totals = np.unique(context, return_inverse=True), None
        known, totals = known[0], np.bincount(known[1], n[at])
        known = known[totals >= (least if k else 0)] if k else np.zeros(1, np.int64)
        place = np.full(symbols**k, -1, np.int64)
        place[known] = np.arange(len(known))
        rows = place[context]
        used = rows >= 0
        all_n = np.zeros((len(known), len(languages)))
        kinds = np.zeros_like(all_n)
        np.add.at(all_n, (rows[used], lang[at][used]), n[at][used])
        np.add.at(kinds, (rows[used], lang[at][used]), 1)
        escape = np.where(all_n > 0, kinds / np.maximum(all_n + kinds, 1), 1.0)
        suffix = shorter[known % symbols ** max(k - 1, 0)] if k else np.zeros(1, np.int64)
        own = chance[suffix] * escape[:, None, :]
        own[rows[used], follower[used], lang[at][used]] = n[at][used] / (all_n + kinds)[rows[used], lang[at][used]]
        levels.append(own)
        ids = np.where(place >= 0, place + states, -1)
        fallback = shorter[np.arange(symbols**k) % symbols ** max(k - 1, 0)] if k else ids
        shorter = np.where(ids >= 0, ids, fallback)
        states += len(known)
        chance = np.concatenate(levels)
    bits = (-np.log2(chance)).astype(np.float32).reshape(states * symbols, len(languages))
    return CodeTable(languages, symbol, shorter, bits, order)


def learn(docs: DataFrame, size: int = SAMPLE) -> CodeTable:
    """Fit on the rows that are not held out. The counts collected are bounded by the sample."""
    return code_table(context_counts(sampled(docs, size)).toPandas())


def predictor(docs: DataFrame, table: CodeTable) -> Callable[[str], F.Column]:
    """A function that makes struct<lang_pred, score> of a text column."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for batch in batches:
            # Texts become Python strings one at a time: a batch may hold ten thousand of any length.
            languages, scores = zip(*[own.predict(value.as_py()) for value in batch]) if len(batch) else ((), ())
            yield pa.StructArray.from_arrays([pa.array(languages, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return lambda text: predict(F.col(text))


def language_predictions(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, learned from those that are not held out."""
    found = docs.select("doc_id", predictor(docs, learn(docs))("text").alias("found"))
    return found.select("doc_id", held_out().alias("held_out"), "found.lang_pred", "found.score")


def with_known_language(docs: DataFrame) -> DataFrame:
    """The rows whose language is clear: not ``und``, and at least ``LEAST_SCORE`` sure."""
    found = docs.select(whole_row(docs), predictor(docs, learn(docs))("text").alias("found"))
    sure = (F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= LEAST_SCORE)
    return found.where(sure).select("_row.*")
