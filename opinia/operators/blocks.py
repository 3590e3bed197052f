"""Documents in blocks and terms in shards that swap packed arrays: what the iterative fits on sparse rows have in common."""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MESSAGE = "target long, kind string, source long, payload binary"


def message(target: int, kind: str, source: int, content) -> tuple:
    return int(target), kind, int(source), pickle.dumps(content, pickle.HIGHEST_PROTOCOL)


def frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["target", "kind", "source", "payload"])


def kinds_of(rows: pd.DataFrame) -> dict[str, list[tuple]]:
    found: dict[str, list[tuple]] = {}
    for kind, source, payload in zip(rows["kind"], rows["source"], rows["payload"]):
        found.setdefault(kind, []).append((int(source), pickle.loads(payload)))
    return {kind: sorted(part, key=lambda m: m[0]) for kind, part in found.items()}


class Rows:
    """Sparse rows of a block."""

    def __init__(self, ids, starts, columns, values, terms):
        self.ids, self.starts, self.columns, self.values, self.terms = ids, starts, columns, values, terms

    def packed(self) -> tuple:
        return self.ids, self.starts, self.columns, self.values, self.terms

    def parts(self):
        return zip(self.starts, self.starts[1:])

    def times(self, factor: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.ids), factor.shape[1]))
        for i, (a, b) in enumerate(self.parts()):
            if b > a:
                out[i] = self.values[a:b] @ factor[self.columns[a:b]]
        return out

    def transposed_times(self, factor: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.terms), factor.shape[1]))
        for i, (a, b) in enumerate(self.parts()):
            out[self.columns[a:b]] += self.values[a:b, None] * factor[i]
        return out

    def sums(self) -> np.ndarray:
        return np.bincount(self.columns, self.values, len(self.terms))


def packed_rows(part: pd.DataFrame) -> Rows:
    part = part.sort_values("doc_id", kind="stable")
    sizes = part["indices"].map(len).to_numpy()
    filled = [(np.asarray(i, np.int64), np.asarray(v, float)) for i, v in zip(part["indices"], part["values"]) if len(i)]
    names = np.concatenate([i for i, _ in filled]) if filled else np.zeros(0, np.int64)
    terms, columns = np.unique(names, return_inverse=True)
    values = np.concatenate([v for _, v in filled]) if filled else np.zeros(0)
    return Rows(part["doc_id"].to_numpy(), np.concatenate([[0], np.cumsum(sizes)]), columns, values, terms)


def dealt_rows(rows: DataFrame, blocks: int, *carried: str):
    """Rows grouped by ``block``, a hash of doc_id."""
    known = rows.select("doc_id", *carried, F.col("indices").cast("array<long>").alias("indices"), "values")
    return known.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks))).groupBy("block")
