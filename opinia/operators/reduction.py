"""Fewer, dense features: randomised truncated SVD (latent semantic analysis) and PCA, on sparse rows of any size.

Block power iteration with a random start: the range of A is caught by Y = A Omega, and a few rounds of Z = A' Y, Y = A Z
turn it to the leading singular vectors. A is cut into tiles, of a block of documents and a shard of terms each. Rows of Y, one for
each document, travel between blocks and shards; Z, with a row for every term by far the larger one, never leaves the task
that holds its shard, of at most ``SHARD_TERMS`` terms. There a block's tile and its rows of Y are read one after the other, so
a task's memory depends on the shard's size and on its part of A, not on the number of documents times columns. Y is made orthonormal through
its Gram matrix (columns x columns, summed up over the blocks), which is all that the driver ever sees, besides sums over columns.
Omega comes from hashes of term numbers, so it needs no storage and a task that is run again gets the same.

PCA is the same on centred columns, without ever making them dense: A - 1 m' times Z is A Z less a row m' Z, and its transpose
times Y is A' Y less m times the column sums of Y.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.operators.blocks import MESSAGE, dealt_rows, frame, message, packed_rows
from opinia.operators.materialize import drop, materialize

ITERATIONS = 5
# Columns more than asked for.
OVERSAMPLED = 10
BLOCK_DOCS = 1024
SHARD_TERMS = 1 << 16
# Directions weaker than this, against the strongest, are noise.
RANK = 1e-12
MERGED_FIRST = 64
# Entries of a tile that are multiplied at a time, and rows of Z that are made or handed on at a time.
CHUNK_ENTRIES = 1 << 13
CHUNK_TERMS = 1 << 12


def random_rows(terms: np.ndarray, columns: int, seed: int) -> np.ndarray:
    """Normal deviates that depend on term number, column and seed alone."""

    def uniform(salt: int) -> np.ndarray:
        x = terms.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(columns, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        x = x + np.uint64((seed * 2 + salt + 1) * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53

    return np.sqrt(-2.0 * np.log1p(-uniform(0))) * np.cos(2 * np.pi * uniform(1))


def _number_of_blocks(rows: DataFrame) -> int:
    return -(-max(rows.count(), 1) // BLOCK_DOCS)


def _whitening(gram: np.ndarray) -> np.ndarray:
    """Turns columns with that Gram matrix into orthonormal ones; directions that are not there become zero."""
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    kept = values > RANK * max(values.max(), 0.0)
    return vectors * np.where(kept, 1.0 / np.sqrt(np.where(kept, values, 1.0)), 0.0)


class Tile:
    """A block's entries in one shard, by document: ``places`` are term numbers divided by the number of shards."""

    def __init__(self, starts: np.ndarray, places: np.ndarray, values: np.ndarray):
        self.starts, self.places, self.values = starts, places, values

    def times(self, z: np.ndarray) -> np.ndarray:
        """documents x columns"""
        out = np.zeros((len(self.starts) - 1, z.shape[1]))
        owner = np.repeat(np.arange(len(out)), np.diff(self.starts))
        _add_products(out, owner, self.places, self.values, z)
        return out

    def add_transposed(self, z: np.ndarray, y: np.ndarray) -> None:
        order = np.argsort(self.places, kind="stable")
        owner = np.repeat(np.arange(len(y)), np.diff(self.starts))
        _add_products(z, self.places[order], owner[order], self.values[order], y)


def _add_products(out: np.ndarray, to: np.ndarray, of: np.ndarray, values: np.ndarray, factor: np.ndarray) -> None:
    """out[to] += values * factor[of], ``to`` ascending, a few entries at a time."""
    for a in range(0, len(to), CHUNK_ENTRIES):
        part = slice(a, a + CHUNK_ENTRIES)
        first = np.flatnonzero(np.append(True, to[part][1:] != to[part][:-1]))
        out[to[part][first]] += np.add.reduceat(values[part, None] * factor[of[part]], first, axis=0)


def _tiles(rows: DataFrame, n_shards: int) -> DataFrame:
    """(block, shard, payload), written out: the tiles of A, and with shard -1 each block's document ids."""
    blocks = _number_of_blocks(rows)

    def cut(part: pd.DataFrame) -> pd.DataFrame:
        block, found = int(part["block"].iloc[0]), packed_rows(part)
        names, owner = found.terms[found.columns], np.repeat(np.arange(len(found.ids)), np.diff(found.starts))
        out = [(block, -1, pickle.dumps(found.ids, pickle.HIGHEST_PROTOCOL))]
        for s in range(n_shards):
            at = np.flatnonzero(names % n_shards == s)
            starts = np.searchsorted(owner[at], np.arange(len(found.ids) + 1))
            if len(at):
                out.append((block, s, pickle.dumps((starts, (names[at] // n_shards).astype(np.int32), found.values[at]), pickle.HIGHEST_PROTOCOL)))
        return pd.DataFrame(out, columns=["block", "shard", "payload"])

    return materialize(dealt_rows(rows, blocks).applyInPandas(cut, "block long, shard long, payload binary"))


def _messages(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(kind, source, content), one at a time."""
    for batch in batches:
        for kind, source, payload in zip(batch["kind"], batch["source"], batch["payload"]):
            yield kind, int(source), payload


def _to_shards(tiles: DataFrame) -> DataFrame:
    return tiles.where("shard >= 0").select(F.col("shard").alias("target"), F.lit("rows").alias("kind"), F.col("block").alias("source"), "payload")


def _to_blocks(tiles: DataFrame) -> DataFrame:
    kind = F.when(F.col("shard") < 0, "ids").otherwise("rows").alias("kind")
    return tiles.select(F.col("block").alias("target"), kind, F.col("shard").alias("source"), "payload")


@dataclass
class Projection:
    """The leading right singular vectors, in shards (names, vectors), several rows each, their singular values, and for PCA what the
    mean document is projected to."""

    shards: DataFrame
    n_shards: int
    values: np.ndarray
    mean: np.ndarray

    def components(self) -> DataFrame:
        """(idx, v array<double>): a row for every term, signs are arbitrary."""

        def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for _, _, payload in _messages(batches):
                names, vectors = pickle.loads(payload)
                yield pd.DataFrame({"idx": names, "v": pd.Series(list(vectors), dtype=object)})

        return self.shards.mapInPandas(rows, "idx long, v array<double>")

    def reduce(self, rows: DataFrame) -> DataFrame:
        """(doc_id, reduced array<double>) of sparse rows; unknown terms do not count."""
        n_shards, mean = self.n_shards, self.mean

        def projected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            tiles, found, shard = [], [], -1
            for kind, source, payload in _messages(batches):
                if kind == "rows":
                    tiles.append((source, payload))
                else:
                    shard = source
                    found.append(pickle.loads(payload))
            if not found:
                return
            size = max(int(names.max()) for names, _ in found) // n_shards + 1
            z = np.zeros((size, len(mean)))
            while found:
                names, vectors = found.pop()
                z[names // n_shards] = vectors
            for block, payload in tiles:
                tile = Tile(*pickle.loads(payload))
                known = tile.places < size
                counts = np.concatenate([[0], np.cumsum(known)])
                tile = Tile(counts[tile.starts], tile.places[known], tile.values[known])
                yield frame([message(block, "part", shard, tile.times(z))])

        def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, total = None, 0.0
            for kind, _, payload in _messages(batches):
                if kind == "ids":
                    ids = pickle.loads(payload)
                else:
                    total = total + pickle.loads(payload)
            reduced = np.zeros((len(ids), len(mean))) + total - mean
            for a in range(0, len(ids), CHUNK_TERMS):
                yield pd.DataFrame({"doc_id": ids[a : a + CHUNK_TERMS], "reduced": pd.Series(list(reduced[a : a + CHUNK_TERMS]), dtype=object)})

        tiles = _tiles(rows, n_shards)
        parts = _to_shards(tiles).unionByName(self.shards).groupBy("target").applyInPandas(projected, MESSAGE)
        ids = _to_blocks(tiles).where("kind = 'ids'")
        return ids.unionByName(parts).groupBy("target").applyInPandas(added, "doc_id long, reduced array<double>")


def fit_svd(rows: DataFrame, components: int, centred: bool = False, iterations: int = ITERATIONS, seed: int = 17) -> Projection:
    """The leading right singular vectors of sparse rows (doc_id, indices, values); with ``centred`` of the centred rows, which
    are the principal axes. No more of them than there are documents."""
    rows = materialize(rows.select("doc_id", "indices", "values"))
    n_docs = max(rows.count(), 1)
    n_terms = rows.select(F.max(F.array_max("indices")).alias("m")).first()["m"]
    n_shards = ((n_terms or 0) + 1) // SHARD_TERMS + 1
    size = (n_terms or 0) // n_shards + 1
    kept = min(components, n_docs)
    width = min(kept + OVERSAMPLED, n_docs)

    def omega(shard: int) -> np.ndarray:
        z = np.empty((size, width))
        for a in range(0, size, CHUNK_TERMS):
            z[a : a + CHUNK_TERMS] = random_rows(np.arange(a, min(a + CHUNK_TERMS, size)) * n_shards + shard, width, seed)
        return z

    def begin(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Shards: their part of Y = A Omega."""
        shard = int(key[0])
        z = omega(shard)
        for _, block, payload in _messages(batches):
            yield frame([message(block, "part", shard, Tile(*pickle.loads(payload)).times(z).astype(np.float32))])

    def up(mean_row: np.ndarray):
        """Blocks: Y from the shards' parts, less the mean's row, back to the shards with their tiles."""

        def step(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            block, n, total, tiles = int(key[0]), 0, 0.0, []
            for kind, source, payload in _messages(batches):
                if kind == "part":
                    total = total + pickle.loads(payload).astype(float)
                elif kind == "rows":
                    tiles.append((source, payload))
                else:
                    n = len(pickle.loads(payload))
            # The Gram matrix is that of the rows as they travel.
            sent = (np.zeros((n, width)) + total - mean_row).astype(np.float32)
            y = sent.astype(float)
            yield frame([message(block, "sums", block, (y.T @ y, y.sum(axis=0)))])
            for shard, payload in tiles:
                yield frame([message(shard, "state", block, (sent, payload))])

        return step

    def down(white: np.ndarray, column_sums: np.ndarray, last: bool):
        """Shards: Z = A' Q, centred, and their part of A Z."""

        def step(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shard, tiles = int(key[0]), []
            z, sums_, seen = np.zeros((size, width)), np.zeros(size), np.zeros(size, bool)
            for _, block, payload in _messages(batches):
                y, payload = pickle.loads(payload)
                tile = Tile(*pickle.loads(payload))
                tile.add_transposed(z, y)
                sums_ += np.bincount(tile.places, tile.values, size)
                seen[tile.places] = True
                tiles.append((block, tile))
            means = sums_ / n_docs if centred else np.zeros(size)
            for a in range(0, size, CHUNK_TERMS):
                part = slice(a, a + CHUNK_TERMS)
                z[part] = z[part] @ white - means[part, None] * column_sums
            yield frame([message(shard, "sums", shard, (z.T @ z, means @ z))])
            if last:
                used = np.flatnonzero(seen)
                for a in range(0, len(used), CHUNK_TERMS):
                    at = used[a : a + CHUNK_TERMS]
                    yield frame([message(shard, "factor", shard, (at * n_shards + shard, z[at]))])
            else:
                for block, tile in tiles:
                    yield frame([message(block, "part", shard, tile.times(z).astype(np.float32))])

        return step

    def sums(messages: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Sums of (columns x columns, columns): added up in groups first, one row comes to the driver."""

        def total(part: pd.DataFrame) -> pd.DataFrame:
            found = [pickle.loads(p) for p in part["payload"]]
            return frame([message(0, "sums", 0, (sum(g for g, _ in found), sum(s for _, s in found)))])

        some = messages.where("kind = 'sums'").groupBy(F.pmod("source", F.lit(MERGED_FIRST))).applyInPandas(total, MESSAGE)
        row = some.groupBy("target").applyInPandas(total, MESSAGE).first()
        return pickle.loads(row["payload"]) if row is not None else (np.zeros((width, width)), np.zeros(width))

    def stepped(messages: DataFrame, step) -> DataFrame:
        return materialize(messages.groupBy("target").applyInPandas(step, MESSAGE))

    tiles = _tiles(rows, n_shards)
    drop(rows)
    parts, mean_row = stepped(_to_shards(tiles), begin), np.zeros(width)
    for iteration in range(iterations + 1):
        found = _to_blocks(tiles).unionByName(parts.where("kind = 'part'"))
        state = stepped(found, up(mean_row if centred else np.zeros(width)))
        # What a step has read is not read again.
        drop(parts)
        gram, column_sums = sums(state)
        white = _whitening(gram)
        turned = column_sums @ white if centred else np.zeros(width)
        parts = stepped(state.where("kind = 'state'"), down(white, turned, iteration == iterations))
        drop(state)
        gram, mean_row = sums(parts)
    squares, turn = np.linalg.eigh((gram + gram.T) / 2)
    order = np.argsort(-squares)[:kept]
    values = np.sqrt(np.maximum(squares[order], 0.0))
    strong = values > np.sqrt(RANK) * max(values.max(initial=0.0), 0.0)
    turn = turn[:, order] * np.where(strong, 1.0 / np.where(strong, values, 1.0), 0.0)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, shard, payload in _messages(batches):
            names, z = pickle.loads(payload)
            yield frame([message(shard, "vectors", shard, (names, z @ turn))])

    shards = materialize(parts.where("kind = 'factor'").mapInPandas(vectors, MESSAGE))
    drop(tiles, parts)
    return Projection(shards, n_shards, values, mean_row @ turn if centred else np.zeros(kept))


def fit_pca(rows: DataFrame, components: int, iterations: int = ITERATIONS, seed: int = 17) -> Projection:
    """Principal axes of sparse rows, on the whole vocabulary."""
    return fit_svd(rows, components, True, iterations, seed)
