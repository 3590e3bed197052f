"""Documents in blocks with a dictionary each, for looking terms up.

A block asks for each of its terms once and gets one answer, so a lookup shuffles blocks x terms rather than documents x
terms, nothing has to be put together again per document, and a term that every document has costs a row per block.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinia.operators.materialize import materialize

# Pairs of document and term in a block, about; a document is never split.
BLOCK_ENTRIES = 1 << 19


def _block(table: pa.Table, number: int, column: str) -> pa.RecordBatch:
    lists = table.column(column).combine_chunks()
    found = lists.flatten()
    counted = pa.types.is_struct(found.type)
    coded = pc.dictionary_encode(found.field("term") if counted else found)
    starts = lists.offsets.to_numpy().astype(np.int64)
    tf = found.field("tf").to_numpy(zero_copy_only=False).astype(np.int64) if counted else np.ones(len(found), np.int64)
    tf = tf.astype(np.min_scalar_type(int(tf.max(initial=0))))
    sink = pa.BufferOutputStream()
    rest = table.drop_columns([column])
    with pa.ipc.new_stream(sink, rest.schema) as out:
        out.write_table(rest)
    rows = pickle.dumps((sink.getvalue().to_pybytes(), starts - starts[0], coded.indices.to_numpy(), tf), pickle.HIGHEST_PROTOCOL)
    names = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([rows], pa.binary()), names], ["block", "rows", "names"])


def packed(terms: DataFrame, column: str = "terms") -> DataFrame:
    """doc_terms (or tokens, in that column) -> (block, rows, names), written out: block numbers must never change between passes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, entries = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                before = sizes[at - 1] if at else 0
                end = min(int(np.searchsorted(sizes, before + BLOCK_ENTRIES - entries)) + 1, batch.num_rows)
                held.append(batch.slice(at, end - at))
                entries, at = entries + int(sizes[end - 1] - before), end
                if entries >= BLOCK_ENTRIES:
                    yield _block(pa.Table.from_batches(held), number, column)
                    number, held, entries = number + 1, [], 0
        if held:
            yield _block(pa.Table.from_batches(held), number, column)

    return materialize(terms.mapInArrow(pack, "block long, rows binary, names array<string>"))


def asked(blocks: DataFrame) -> DataFrame:
    """(block, place, term): what the blocks ask for."""
    return blocks.select("block", F.posexplode("names").alias("place", "term"))


def asked_by_fold(blocks: DataFrame) -> DataFrame:
    """(block, place, fold, term): the terms that a block's documents of each ``fold`` have."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                block = Block(pa.Table.from_batches([row]))
                n = max(len(block.names), 1)
                pairs = np.unique(block.per_entry("fold") * n + block.codes)
                place = pairs % n
                columns = [np.full(len(pairs), row.column("block")[0].as_py(), np.int64), place.astype(np.int32), (pairs // n).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), block.names.take(pa.array(place))], ["block", "place", "fold", "term"])

    return blocks.mapInArrow(ask, "block long, place int, fold int, term string")


class Block:
    """The documents of a block: ``rest`` are their other columns, document i has the entries ``starts[i]:starts[i + 1]``, of
    the terms ``names[codes]``."""

    def __init__(self, table: pa.Table):
        rest, self.starts, self.codes, self.tf = pickle.loads(table.column("rows")[0].as_py())
        self.rest = pa.ipc.open_stream(rest).read_all()
        self.names = table.column("names").combine_chunks().flatten()

    def told(self, replies: pa.Table, column: str, missing: float = np.nan) -> np.ndarray:
        """A column of the replies by place in ``names``."""
        out = np.full(len(self.names), missing, replies.column(column).type.to_pandas_dtype())
        out[replies.column("place").to_numpy()] = replies.column(column).to_numpy()
        return out

    def per_entry(self, column: str) -> np.ndarray:
        """A column of whole numbers of the documents, for each of their entries."""
        return np.repeat(self.rest.column(column).to_numpy().astype(np.int64), np.diff(self.starts))

    def per_document(self, values: np.ndarray) -> np.ndarray:
        sums, filled = np.zeros(len(self.starts) - 1), np.flatnonzero(np.diff(self.starts))
        if len(filled):
            sums[filled] = np.add.reduceat(values, self.starts[filled])
        return sums


def told_blocks(blocks: DataFrame, table: DataFrame, values: list[str], step: Callable[[Block, pa.Table], pa.Table], schema: T.StructType, by_fold: bool = False) -> DataFrame:
    """``step`` of every block and what ``table`` (term, values) has for its terms, in columns place and ``values``.

    With ``by_fold`` the values are arrays by fold, of which a block is told those that its documents with the term are in, in
    columns place, fold and ``values``; the first is never null.
    """
    table = table.select("term", *values)
    if by_fold:
        of_fold = [F.get(v, F.col("fold")).alias(v) for v in values]
        replies = asked_by_fold(blocks).join(table, "term").select("block", "place", "fold", *of_fold).where(F.col(values[0]).isNotNull())
    else:
        replies = asked(blocks).join(table, "term").drop("term")
    replies = replies.withColumnRenamed("block", "asker")
    both = blocks.groupBy("block").cogroup(replies.groupBy("asker"))
    return both.applyInArrow(lambda rows, found: step(Block(rows), found), schema)


def other_fields(terms: DataFrame, column: str = "terms") -> list[T.StructField]:
    return [T.StructField(f.name, f.dataType) for f in terms.schema.fields if f.name != column]


def swapped_tokens(tokens: DataFrame, stems: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Every token becomes the ``stem`` that ``stems`` adds to a table (word) of all distinct ones; order and repeats stay."""
    blocks = packed(tokens, "tokens")
    table = stems(blocks.select(F.explode("names").alias("word")).distinct()).withColumnRenamed("word", "term")

    def swap(block: Block, found: pa.Table) -> pa.Table:
        row = np.zeros(len(block.names), np.int64)
        row[found.column("place").to_numpy()] = np.arange(found.num_rows)
        stem = found.column("stem").combine_chunks()
        lists = pa.ListArray.from_arrays(pa.array(block.starts, pa.int32()), stem.take(pa.array(row[block.codes])))
        return block.rest.append_column("tokens", lists)

    schema = T.StructType([*other_fields(tokens, "tokens"), T.StructField("tokens", T.ArrayType(T.StringType()))])
    return told_blocks(blocks, table, ["stem"], swap, schema)


def document_sums(terms: DataFrame, table: DataFrame, values: list[str], sums: dict[str, tuple[str | None, int]]) -> DataFrame:
    """doc_terms x (term, idf, values) -> (doc_id, ..., sums): each sum is of a value (None: of ones) times the power of
    tf * idf over the known terms of a document, null where there are none."""

    def add(block: Block, found: pa.Table) -> pa.Table:
        raw = block.tf * block.told(found, "idf")[block.codes]
        known = ~np.isnan(raw)
        raw, lone = np.where(known, raw, 0.0), block.per_document(known) == 0
        out = block.rest
        for name, (value, power) in sums.items():
            factor = known if value is None else np.where(known, block.told(found, value)[block.codes], 0.0)
            out = out.append_column(name, pa.array(block.per_document(factor * raw**power), pa.float64(), mask=lone))
        return out

    schema = T.StructType([*other_fields(terms), *[T.StructField(name, T.DoubleType()) for name in sums]])
    return told_blocks(packed(terms), table, ["idf", *values], add, schema)


def counted_terms(blocks: DataFrame, folds: int = 0) -> DataFrame:
    """(term, df, cf, _0, _1, ...): documents and occurrences per term, and documents by ``fold``, counted in the blocks first."""
    sums = ["df", "cf", *[f"_{f}" for f in range(folds)]]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(pa.Table.from_batches([batch.slice(i, 1)]))
                n = len(block.names)
                counts = [np.bincount(block.codes, minlength=n), np.bincount(block.codes, block.tf, n).astype(np.int64)]
                if folds:
                    counts += list(np.bincount(block.per_entry("fold") * n + block.codes, minlength=folds * n).reshape(folds, n))
                yield pa.RecordBatch.from_arrays([block.names, *map(pa.array, counts)], ["term", *sums])

    found = blocks.mapInArrow(count, ", ".join(["term string", *[f"{c} long" for c in sums]]))
    return found.groupBy("term").agg(*[F.sum(c).alias(c) for c in sums])


def _weights(block: Block, found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Which entries have a known term, and their weights, of unit length by document."""
    raw = block.tf * block.told(found, "idf")[block.codes]
    known = np.flatnonzero(~np.isnan(raw))
    length = np.sqrt(block.per_document(np.nan_to_num(raw) ** 2))
    return known, raw[known] / np.repeat(length, np.diff(block.starts))[known]


def weight_moments(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """(term, idf, n, sum, squares, min, max) of the terms' weights, summed up in the blocks first."""

    def add(block: Block, found: pa.Table) -> pa.Table:
        known, w = _weights(block, found)
        codes = block.codes[known]
        order = np.argsort(codes, kind="stable")
        w, codes = w[order], codes[order]
        first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
        over = (lambda f, x: f.reduceat(x, first)) if len(first) else (lambda f, x: np.zeros(0))
        places = codes[first]
        columns = {
            "term": block.names.take(pa.array(places)), "idf": block.told(found, "idf")[places], "n": np.diff(np.append(first, len(codes))).astype(np.int64),
            "sum": over(np.add, w), "squares": over(np.add, w * w), "min": over(np.minimum, w), "max": over(np.maximum, w),
        }
        return pa.table({name: column if name == "term" else pa.array(column) for name, column in columns.items()})

    schema = T.StructType([T.StructField("term", T.StringType()), *[T.StructField(c, T.LongType() if c == "n" else T.DoubleType()) for c in ("idf", "n", "sum", "squares", "min", "max")]])
    parts = told_blocks(blocks, words, ["idf"], add, schema)
    return parts.groupBy("term").agg(
        F.max("idf").alias("idf"), F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.sum("squares").alias("squares"), F.min("min").alias("min"), F.max("max").alias("max")
    )


def class_sums(blocks: DataFrame, words: DataFrame, classes: list[str]) -> DataFrame:
    """(term, idf, df, s_<i>, q_<i>): documents with a term, sums of weights and of squared weights by class, summed up in the
    blocks first."""

    def add(block: Block, found: pa.Table) -> pa.Table:
        known, w = _weights(block, found)
        codes, n, places = block.codes[known], len(block.names), found.column("place").to_numpy()
        label = np.array(block.rest.column("class").to_pylist(), object)
        columns = {"term": block.names.take(pa.array(places)), "idf": found.column("idf"), "df": pa.array(np.bincount(codes, minlength=n)[places])}
        for i, name in enumerate(classes):
            # A missing label counts for no class.
            own = np.where(np.repeat(label == name, np.diff(block.starts))[known], w, 0.0) if name is not None else np.zeros(len(w))
            columns |= {f"s_{i}": pa.array(np.bincount(codes, own, n)[places]), f"q_{i}": pa.array(np.bincount(codes, own * own, n)[places])}
        return pa.table(columns)

    sums = [f"{c}_{i}" for i in range(len(classes)) for c in ("s", "q")]
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("idf", T.DoubleType()), T.StructField("df", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in sums]])
    parts = told_blocks(blocks, words, ["idf"], add, schema)
    return parts.groupBy("term").agg(F.max("idf").alias("idf"), F.sum("df").alias("df"), *[F.sum(c).alias(c) for c in sums])


def weight_counts(blocks: DataFrame, table: DataFrame, least: float) -> DataFrame:
    """(term, n, w, times): the distinct weights of the terms of ``table`` (term, idf, n) with more than ``least`` documents."""

    def count(block: Block, found: pa.Table) -> pa.Table:
        known, w = _weights(block, found)
        n = block.told(found, "n", 0)
        wide = n[block.codes[known]] > least
        pairs = np.rec.fromarrays([block.codes[known][wide].astype(np.int64), w[wide]], names="code,w")
        distinct, times = np.unique(pairs, return_counts=True)
        return pa.table({"term": block.names.take(pa.array(distinct["code"])), "n": pa.array(n[distinct["code"]].astype(np.int64)), "w": pa.array(distinct["w"]), "times": pa.array(times.astype(np.int64))})

    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("n", T.LongType()), T.StructField("w", T.DoubleType()), T.StructField("times", T.LongType())])
    parts = told_blocks(blocks, table, ["idf", "n"], count, schema)
    return parts.groupBy("term", "n", "w").agg(F.sum("times").alias("times"))


def tfidf_rows(terms: DataFrame, words: DataFrame, name: str) -> DataFrame:
    """doc_terms x vocabulary with idf -> (doc_id, ..., weights) of unit length, scaled where the vocabulary says so."""
    return weighed_blocks(packed(terms), other_fields(terms), words, name)


def weighed_blocks(blocks: DataFrame, fields: list[T.StructField], words: DataFrame, name: str = "term") -> DataFrame:
    """``tfidf_rows`` of documents that are in blocks already; ``fields`` are their other columns."""
    extra = [c for c in (name, "scale", "shift") if c != "term" and c in words.columns]
    named = T.StructField(name, words.schema[name].dataType)
    unit = T.ArrayType(T.StructType([named, T.StructField("w", T.DoubleType())]))

    def weigh(block: Block, found: pa.Table) -> pa.Table:
        known, w = _weights(block, found)
        codes = block.codes[known]
        if "scale" in extra:
            w = (w - block.told(found, "shift")[codes]) / block.told(found, "scale")[codes]
        if name == "term":
            label = block.names.take(pa.array(codes))
        else:
            label = pa.array(block.told(found, name, 0)[codes])
        pairs = pa.StructArray.from_arrays([label, pa.array(w)], [name, "w"])
        weights = pa.ListArray.from_arrays(pa.array(np.searchsorted(known, block.starts), pa.int32()), pairs)
        return block.rest.append_column("weights", weights)

    return told_blocks(blocks, words, ["idf", *extra], weigh, T.StructType([*fields, T.StructField("weights", unit)]))
