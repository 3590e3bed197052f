"""Language-model scores of texts: an interpolated modified Kneser-Ney model of word pairs.

Tokens are words, ASCII letters in lower case, and one end for each text. With c the count of a pair of neighbours,
the probability of a token after the one before is (c - D(c)) / c(before) + g(before) * q(token), where q does the same
one order lower, over the number of different tokens before it, down to a uniform chance for words never seen. The
discounts D of counts 1, 2 and 3 or more come from the counts of counts, g gives back what they took.

Words and pairs are 64-bit hashes from end to end; words are cut and hashed as whole arrays of bytes.

Counting: a task counts the pairs of about ``PART_TOKENS`` tokens at a time and deals them out by the first word, so that
all that follows a word meets in one shard; first words that hold a large share of all tokens (at most ``2 * HOT_SHARE``, from a sample;
they decide who travels where, never a result) are dealt by the whole pair. A shard merges its pairs, writes them as a
sorted array of hashes with counts beside it, and hands on a row per word; summed up per word, these hold all
that the lower order and the discounts need. They are written as sorted arrays as well.

Scoring: the arrays lie in the folder that driver and executors share, and workers map them into memory; a worker reads
those pages that its texts ask for, memory holds what is in use. Files in a store that cannot be mapped are copied
to the worker first. Neither driver nor broadcast hold any part of the model besides a dozen numbers. Counts cover all
that is learned from; nothing is pruned, so the model grows with the corpus.

Null text counts as empty: its only token is the end. Rows without a doc_id are scored, neither held out nor learned
from. Rows that repeat a doc_id are texts of their own. Without anything to learn from every score is 0. Other columns
are not looked at.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from opinia.llm.storage import partitions, written
from opinia.llm.words import U, blocks, mix, text_bytes, words_of
from opinia.operators.materialize import checkpoint_folder

# Tokens counted or looked up at a time, and tokens of one shard on the average.
PART_TOKENS = 1 << 22
LOOKED_UP = 1 << 20
SHARD_TOKENS = 1 << 20
TOKEN_BYTES = 6
HOT_SHARE = 2048
HOT_SAMPLE_BYTES = 1 << 26
# Counts from here on stand in a list of their own.
LARGE = 255
BASE_DISCOUNT = 0.5
ALPHA = 0.1
BOS, END = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)
ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
SUMS = ["total", "n1", "n2", "n3", "n4", "n5", "preceded"]


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * U(0xD6E8FEB86659FD93) + mix(second))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of hashes: grows with the hash."""
    return (((hashes >> U(32)) * U(shards)) >> U(32)).astype(np.int64)


@dataclass
class Grams:
    """Neighbouring tokens of a few texts: ``text`` is the number of the text that a pair belongs to."""

    first: np.ndarray
    second: np.ndarray
    text: np.ndarray


def _sequence(hashes: np.ndarray, counts: np.ndarray, leads: np.ndarray, ended: np.ndarray, texts: np.ndarray) -> Grams:
    """Pairs of [lead, words, end] of every piece; a piece that goes on elsewhere has no end."""
    lengths = counts + 1 + ended
    at = np.cumsum(lengths) - lengths
    tokens = np.empty(int(lengths.sum()), np.uint64)
    tokens[at] = leads
    tokens[np.arange(len(hashes)) + np.repeat(at + 1 - (np.cumsum(counts) - counts), counts)] = hashes
    closing = ended.astype(bool)
    tokens[(at + counts + 1)[closing]] = END
    inside = np.ones(max(len(tokens) - 1, 0), bool)
    inside[at[1:] - 1] = False
    return Grams(tokens[:-1][inside], tokens[1:][inside], np.repeat(texts, counts + ended))


def grams_of(column: pa.Array) -> Iterator[Grams]:
    """The pairs of a column of texts, in blocks of bounded size; texts of any length are cut between words."""
    offsets, data = text_bytes(column)
    lead = BOS
    for at, upto, low, high, begins, ends in blocks(offsets, data):
        starts = offsets[at:upto] - low if begins and ends else np.zeros(1, np.int64)
        hashes, _, _, counts = words_of(data[low:high], starts)
        n = upto - at
        leads = np.full(n, BOS if begins else lead)
        yield _sequence(hashes, counts, leads, np.full(n, int(ends)), np.arange(at, upto))
        lead = hashes[-1] if len(hashes) else leads[0]


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted keys."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def merged(first: np.ndarray, second: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs in order, with their counts."""
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    at = _runs(first, second)
    counts = np.diff(np.append(at, len(first))) if n is None else (np.add.reduceat(n[order], at) if len(at) else n)
    return first[at], second[at], counts.astype(np.int64)


def _small(values: np.ndarray) -> list[np.ndarray]:
    """Numbers as bytes, large ones in a list behind."""
    return [np.minimum(values, LARGE).astype(np.uint8), values[values >= LARGE].astype(np.int64)]


def _large(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    values = small.astype(np.int64)
    values[small == LARGE] = large
    return values


def packed(first: np.ndarray, second: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted pairs in about ten bytes each: a first word is written once."""
    at = _runs(first)
    arrays = [first[at], *_small(np.diff(np.append(at, len(first)))), second, *_small(n)]
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kinds = [np.uint64, np.uint8, np.int64, np.uint64, np.uint8, np.int64]
    sizes, at, arrays = np.frombuffer(blob, np.int64, len(kinds)), 8 * len(kinds), []
    for size, kind in zip(sizes, kinds):
        arrays.append(np.frombuffer(blob, kind, int(size), at))
        at += arrays[-1].nbytes
    words, runs, long_runs, second, n, large_n = arrays
    return np.repeat(words, _large(runs, long_runs)), second, _large(n, large_n)


def _batch(schema: str, *columns) -> pa.RecordBatch:
    fields = [pa.field(name, ARROW[kind]) for name, kind in (part.split() for part in schema.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=pa.schema(fields))


def hot_words(texts: DataFrame, total_bytes: int) -> np.ndarray:
    """First words with a large share of the tokens, by a sample of the rows: at most 2 * HOT_SHARE."""
    ratio = max(1, total_bytes // HOT_SAMPLE_BYTES)
    schema = "word long, n long, whole long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grams in grams_of(batch.column(0)):
                words, n = np.unique(grams.first, return_counts=True)
                often = n * (2 * HOT_SHARE) >= n.sum()
                # Their blocks' tokens ride along on the first row.
                yield _batch(schema, np.append(words[often].view(np.int64), 0), np.append(n[often], 0), np.append(np.zeros(often.sum(), np.int64), n.sum()))

    sample = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(ratio)) == 0).select("text")
    counts = sample.mapInArrow(count, schema).groupBy("word").agg(F.sum("n").alias("n"), F.sum("whole").alias("whole"))
    counts = written(counts)
    whole = counts.agg(F.sum("whole").alias("whole")).first()["whole"] or 0
    rows = counts.where((F.col("n") * HOT_SHARE >= whole) & (F.col("n") > 0)).select("word").collect()
    return np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64))


def dealt(first: np.ndarray, second: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each pair."""
    place = shard_of(first, shards)
    often = np.isin(first, hot)
    if often.any():
        place[often] = shard_of(pair_hashes(first[often], second[often]), shards)
    return place


def _local(folder: str) -> str | None:
    """The folder as a path, if it lies in a file system."""
    found = re.match(r"(?:file:/*)?(/.*)|file:/*(.*)", folder)
    return None if not found else found[1] or "/" + found[2]


def store(folder: str, name: str, arrays: list[np.ndarray]) -> None:
    """Writes arrays behind each other, whole or not at all; the same name always gets the same content."""
    path = _local(folder)
    head = np.array([len(arrays), *[len(a) for a in arrays]], np.int64)
    if path is not None:
        os.makedirs(path, exist_ok=True)
        draft = f"{path}/.{name}-{uuid.uuid4().hex}"
        with open(draft, "wb") as f:
            for a in (head, *arrays):
                f.write(np.ascontiguousarray(a).data)
        os.replace(draft, f"{path}/{name}")
        return
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(folder)
    system.create_dir(place, recursive=True)
    draft = f"{place}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as f:
        for a in (head, *arrays):
            f.write(np.ascontiguousarray(a).tobytes())
    system.move(draft, f"{place}/{name}")


@lru_cache(maxsize=512)
def load(folder: str, name: str, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """The arrays of a file, mapped into memory; none if there is no such file, as nothing fell into its range."""
    path = _local(folder)
    if path is not None:
        path = f"{path}/{name}"
        if not os.path.exists(path):
            return [np.zeros(0, k) for k in kinds]
    else:
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(folder)
        if system.get_file_info(f"{place}/{name}").type == fs.FileType.NotFound:
            return [np.zeros(0, k) for k in kinds]
        copy = tempfile.NamedTemporaryFile()
        fs.copy_files(f"{place}/{name}", copy.name, source_filesystem=system, destination_filesystem=fs.LocalFileSystem())
        path = copy.name
    whole = np.memmap(path, np.uint8, "r")
    sizes = whole[8 : 8 + 8 * len(kinds)].view(np.int64)
    at, arrays = 8 + 8 * len(kinds), []
    for size, kind in zip(sizes, kinds):
        width = np.dtype(kind).itemsize
        arrays.append(whole[at : at + int(size) * width].view(kind))
        at += int(size) * width
    return arrays


# Wide numbers first, so that each array begins at a multiple of its width.
PAIR_KINDS = ("u8", "i8", "u1")
WORD_KINDS = ("u8", "i8", "f8", "f8")


def pair_rows(texts: DataFrame, hot: np.ndarray, shards: int) -> DataFrame:
    """(shard, pairs): counted pairs of parts of the texts, packed."""
    schema = "shard int, pairs binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Room for one part, used again and again.
        rooms = np.empty(PART_TOKENS, np.uint64), np.empty(PART_TOKENS, np.uint64)
        used = 0

        def part() -> Iterator[pa.RecordBatch]:
            first, second, n = merged(rooms[0][:used], rooms[1][:used])
            place = dealt(first, second, hot, shards)
            order = np.argsort(place, kind="stable")
            starts = _runs(place[order])
            for low, high in zip(starts, np.append(starts[1:], len(order))):
                chosen = order[low:high]
                yield _batch(schema, [int(place[chosen[0]])], [packed(first[chosen], second[chosen], n[chosen])])

        for batch in batches:
            for grams in grams_of(batch.column(0)):
                done = 0
                while done < len(grams.first):
                    taken = min(len(grams.first) - done, PART_TOKENS - used)
                    for room, values in zip(rooms, (grams.first, grams.second)):
                        room[used : used + taken] = values[done : done + taken]
                    used, done = used + taken, done + taken
                    if used == PART_TOKENS:
                        yield from part()
                        used = 0
        if used:
            yield from part()

    return texts.select("text").mapInArrow(count, schema)


def shard_words(pairs: DataFrame, folder: str) -> DataFrame:
    """Writes the shards' arrays of pairs, and returns (word, ...) with ``SUMS``: parts of what is known about words.

    total: tokens after the word; n1 to n5: different tokens that follow it once to four times and more often;
    preceded: different tokens before it.
    """
    schema = "word long, " + ", ".join(f"{name} long" for name in SUMS)

    def finish(shard: int, blobs: list[bytes]) -> pa.RecordBatch:
        first, second, n = merged(*(np.concatenate(c) for c in zip(*map(unpacked, blobs))))
        keys = pair_hashes(first, second)
        order = np.argsort(keys)
        small, large = _small(n[order])
        store(folder, f"pairs-{shard}", [keys[order], large, small])
        at = _runs(first)
        found = {"total": np.add.reduceat(n, at)}
        for k in range(1, 6):
            found[f"n{k}"] = np.add.reduceat((n == k if k < 5 else n >= k).astype(np.int64), at)
        behind, preceded = np.unique(second, return_counts=True)
        # One row per word of the shard, on either side of a pair.
        words = np.union1d(first[at], behind)
        columns = {name: np.zeros(len(words), np.int64) for name in SUMS}
        places = np.searchsorted(words, first[at])
        for name, values in found.items():
            columns[name][places] = values
        columns["preceded"][np.searchsorted(words, behind)] = preceded
        return _batch(schema, words.view(np.int64), *[columns[name] for name in SUMS])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if blobs and shard != now:
                    yield finish(now, blobs)
                    blobs = []
                now = shard
                blobs.append(blob.as_py())
        if blobs:
            yield finish(now, blobs)

    by_shard = pairs.repartition(partitions(pairs.sparkSession), "shard").sortWithinPartitions("shard")
    return by_shard.mapInArrow(shards, schema)


def discounts(counts: list[int]) -> np.ndarray:
    """D of counts 0, 1, 2, 3 and more, from the numbers of counts 1 to 4. Where those are too few to tell, or tell nonsense,
    half a count is taken."""
    n1, n2, n3, n4 = counts
    share = n1 / (n1 + 2 * n2) if n1 else BASE_DISCOUNT
    found = [0.0]
    for k, (here, more) in enumerate([(n1, n2), (n2, n3), (n3, n4)], 1):
        d = k - (k + 1) * share * more / here if here else BASE_DISCOUNT
        found.append(d if 0 < d < k else BASE_DISCOUNT)
    return np.array(found)


@dataclass
class Model:
    """Where the arrays lie and the few numbers that hold for all of them."""

    folder: str
    shards: int
    hot: np.ndarray
    tokens: int
    words: int
    pair_discounts: np.ndarray
    unseen: float

    def word_values(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count, lower-order probability, weight given back) of sorted words."""
        count, lower, back = np.zeros(len(words), np.int64), np.full(len(words), self.unseen), np.ones(len(words))
        place = shard_of(words, self.shards)
        starts = _runs(place)
        for low, high in zip(starts, np.append(starts[1:], len(words))):
            known, *values = load(self.folder, f"words-{place[low]}", WORD_KINDS)
            asked = words[low:high]
            at = np.minimum(np.searchsorted(known, asked), max(len(known) - 1, 0))
            if len(known):
                hit = np.flatnonzero(known[at] == asked)
                for column, value in zip((count, lower, back), values):
                    column[low + hit] = value[at[hit]]
        return count, lower, back

    def pair_counts(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        keys, place = pair_hashes(first, second), dealt(first, second, self.hot, self.shards)
        # Sorted questions read the arrays from front to back.
        order = np.argsort(keys)
        order = order[np.argsort(place[order], kind="stable")]
        keys, place = keys[order], place[order]
        found = np.zeros(len(keys), np.int64)
        starts = _runs(place)
        for low, high in zip(starts, np.append(starts[1:], len(keys))):
            known, large, small = load(self.folder, f"pairs-{place[low]}", PAIR_KINDS)
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, keys[low:high]), len(known) - 1)
            hit = np.flatnonzero(known[at] == keys[low:high])
            values = small[at[hit]].astype(np.int64)
            big = np.flatnonzero(values == LARGE)
            if len(big):
                # The list of large counts is as long as there are such pairs, in their order.
                values[big] = large[np.searchsorted(_large_places(self.folder, int(place[low])), at[hit][big])]
            found[low + hit] = values
        result = np.empty_like(found)
        result[order] = found
        return result

    def logs(self, grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count of the second token, log10 of its base chance, log10 of its chance after the first) of every pair."""
        words, at = np.unique(np.concatenate([grams.first, grams.second]), return_inverse=True)
        count, lower, back = self.word_values(words)
        first, second = at[: len(grams.first)], at[len(grams.first) :]
        c = self.pair_counts(grams.first, grams.second)
        left = c - self.pair_discounts[np.minimum(c, 3)]
        seen = count[first]
        # What follows the start and the end are counted alike: both stand once in every text.
        p = np.where(seen > 0, left / np.maximum(seen, 1), 0.0) + back[first] * lower[second]
        known = count[second]
        base = np.log10((known + ALPHA) / (self.tokens + ALPHA * (self.words + 1)))
        return known, base, np.log10(p)


@lru_cache(maxsize=512)
def _large_places(folder: str, shard: int) -> np.ndarray:
    return np.flatnonzero(load(folder, f"pairs-{shard}", PAIR_KINDS)[2] == LARGE)


def fit(texts: DataFrame) -> Model:
    """Learns from all rows of ``texts`` (doc_id, text)."""
    spark = texts.sparkSession
    folder = f"{checkpoint_folder(spark)}/lm-{uuid.uuid4().hex}"
    total = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = total // (TOKEN_BYTES * SHARD_TOKENS) + 1
    hot = hot_words(texts, total)
    parts = shard_words(pair_rows(texts, hot, shards), folder)
    words = written(parts.groupBy("word").agg(*[F.sum(name).alias(name) for name in SUMS]))
    # The start follows nothing, the end is followed by nothing; the end is as frequent as the start.
    end = F.col("word") == int(END.view(np.int64))
    start = F.col("word") == int(BOS.view(np.int64))
    sums = words.agg(
        *[F.coalesce(F.sum(f"n{k}"), F.lit(0)).alias(f"n{k}") for k in range(1, 5)],
        *[F.count_if(F.col("preceded") == k).alias(f"p{k}") for k in range(1, 5)],
        F.count_if(F.col("preceded") >= 3).alias("p3_more"),
        F.coalesce(F.sum("preceded"), F.lit(0)).alias("pairs"),
        F.count_if(F.col("preceded") > 0).alias("words"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.when(start, F.col("total"))), F.lit(0)).alias("texts"),
    ).first()
    d = discounts([sums[f"n{k}"] for k in range(1, 5)])
    e = discounts([sums[f"p{k}"] for k in range(1, 5)])
    taken = e[1] * sums["p1"] + e[2] * sums["p2"] + e[3] * sums["p3_more"]
    unseen = (taken / sums["pairs"] if sums["pairs"] else 1.0) / (sums["words"] + 1)
    n_texts, pairs = sums["texts"], max(sums["pairs"], 1)

    schema = "shard int, n long"
    end_word, start_word = END, BOS

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(shard: int, rows: list[list[np.ndarray]]) -> pa.RecordBatch:
            word, total, n1, n2, n3, n4, n5, preceded = (np.concatenate(c) for c in zip(*rows))
            word = word.view(np.uint64)
            order = np.argsort(word)
            followed = np.maximum(total, 1)
            back = np.where(total > 0, (d[1] * n1 + d[2] * n2 + d[3] * (n3 + n4 + n5)) / followed, 1.0)
            lower = (preceded - e[np.minimum(preceded, 3)]) / pairs + unseen
            lower[preceded == 0] = unseen
            count = np.where(word == end_word, n_texts, total)
            store(folder, f"words-{shard}", [word[order], count[order], lower[order], back[order]])
            return _batch(schema, [shard], [len(word)])

        now, rows = None, []
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            starts = _runs(columns[0])
            for low, high in zip(starts, np.append(starts[1:], len(columns[0]))):
                if rows and columns[0][low] != now:
                    yield finish(now, rows)
                    rows = []
                now = int(columns[0][low])
                rows.append([c[low:high] for c in columns[1:]])
        if rows:
            yield finish(now, rows)

    # The same ranges as ``shard_of``, on the upper half of the hash.
    placed = words.withColumn("shard", F.shiftright(F.shiftrightunsigned("word", 32) * shards, 32).cast("int"))
    by_shard = placed.repartition(partitions(spark), "shard").sortWithinPartitions("shard")
    by_shard.select("shard", "word", *SUMS).mapInArrow(write, schema).agg(F.sum("n")).collect()
    return Model(folder, shards, hot, sums["tokens"], sums["words"], d, unseen)


SCORES = "n_tokens long, n_known long, base_score double, score double"


def scored(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row of ``df``."""
    schema = StructType([StructField("doc_id", df.schema["doc_id"].dataType), *StructType.fromDDL(SCORES).fields])

    arrow = to_arrow_schema(schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sums = np.zeros((4, n))
            held: list[Grams] = []

            def settle() -> None:
                grams = Grams(*(np.concatenate([getattr(g, part) for g in held]) for part in ("first", "second", "text")))
                held.clear()
                known, base, log = model.logs(grams)
                for k, values in enumerate((None, known > 0, base, log)):
                    sums[k] += np.bincount(grams.text, values, n)

            for grams in grams_of(batch.column(1)):
                held.append(grams)
                if sum(len(g.first) for g in held) >= LOOKED_UP:
                    settle()
            if held:
                settle()
            columns = [sums[0].astype(np.int64), sums[1].astype(np.int64), sums[2], sums[3]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], schema=arrow)

    return df.select("doc_id", text).mapInArrow(score, schema)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))


def language_model_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every document, learned from
    those that are not held out."""
    learned = docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "text")
    model = fit(learned)
    found = scored(docs, model)
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return found.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", perplexity.alias("perplexity"),
    )
