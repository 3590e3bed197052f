"""Near-duplicates by SimHash, found through anchor points of a covering code.

A fingerprint has 64 bits from the hashes of a text's word shingles. Two fingerprints that differ in at most three bits
differ in at most one bit in one of their halves. On 31 bits of a half the words of the perfect Hamming code [31, 26]
are the anchors: every value lies within distance 1 (the covering radius) of exactly one anchor, its home. A fingerprint
is copied to all anchors within covering radius plus threshold, 1 + 1 = 2, of its halves: 16 at most each. For any
linked pair one of the two meets the other at its own home, so comparing home rows with copies per anchor finds every link.

What keeps it bounded:
- Equal fingerprints are merged first; copies cost nothing more.
- Copies at anchors where nothing is at home are dropped right after the first shuffle, which is nearly all of them.
- At an anchor with more than ``CROWDED`` homes, pairs also agree in one of the four bytes of the other half (three
  differing bits cannot touch four bytes), so rows are dealt again by that byte. This is exact; no pair is dropped.
- Components come from rounds of minimum labels with pointer jumping over links between distinct fingerprints only.
- All joins of fingerprints shuffle both sides, however small Spark takes one to be; only the driver's few hot ones are broadcast.
- Labels go back to documents through a shuffle; the few fingerprints that hold 1/1024 of all rows or more, at most
  1,024 of them, go by broadcast.

Null text counts as empty; no word gives fingerprint zero, which links like any other. Rows that repeat a doc_id each get
their row. A null doc_id counts only where a group has no other; then its component_id is null too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinia.llm.storage import shuffled, whole_row, written

SHINGLE = 3
SEED = 42
THRESHOLD = 3
CROWDED = 512
HOT_SHARE = 1024
# Shingles hashed at a time, which bounds memory for very long texts.
BLOCK = 1 << 16
ANCHOR_BITS = 31


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of one text."""
    from xxhash import xxh64_intdigest

    # Bytes know only the ASCII letters and white space, which is what is asked for.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = max(len(words) - shingle + 1, 1)
    if not words:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        part = words[at : at + BLOCK + shingle - 1]
        runs = map(b" ".join, zip(*(part[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.array([xxh64_intdigest(s, seed) for s in runs], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): fingerprints as signed 64-bit numbers."""

    @F.arrow_udf("long")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            # Texts become Python strings one at a time: a batch may hold ten thousand of any length.
            values = np.array([fingerprint(value.as_py(), shingle, seed) for value in batch], dtype=np.uint64)
            yield pa.array(values.view(np.int64))

    return docs.select("doc_id", prints(F.col(text)).alias("fp"))


def anchors_near(values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(row numbers, anchors, at home?) for 31-bit values: all code words within distance 2."""
    syndrome = np.zeros(len(values), np.int64)
    for position in range(1, ANCHOR_BITS + 1):
        syndrome ^= ((values >> (position - 1)) & 1) * position
    everyone, off = np.arange(len(values)), syndrome > 0
    flip = np.where(off, np.int64(1) << np.maximum(syndrome - 1, 0), 0)
    yield everyone, values ^ flip, True
    # Two flipped bits lead to a code word if their positions add up to the syndrome; each such pair once.
    for position in range(1, ANCHOR_BITS + 1):
        other = syndrome ^ position
        chosen = np.flatnonzero(off & (other > position))
        yield chosen, values[chosen] ^ (1 << (position - 1)) ^ (np.int64(1) << (other[chosen] - 1)), False


def anchored(distinct: DataFrame) -> DataFrame:
    """(anchor, fp, home): every distinct fingerprint at all anchors within reach of either half."""

    def copies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy()
            for half in (0, 1):
                values = (fps >> (32 * half)) & ((1 << ANCHOR_BITS) - 1)
                for rows, anchors, home in anchors_near(values):
                    if not len(rows):
                        continue
                    yield pd.DataFrame({"anchor": anchors | (half << ANCHOR_BITS), "fp": fps[rows], "home": home})

    return distinct.select("fp").mapInPandas(copies, "anchor long, fp long, home boolean")


def links(distinct: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(low, high): pairs of distinct fingerprints that differ in at most three bits, each once."""
    rows = anchored(distinct)
    homes = rows.where("home").groupBy("anchor").agg(F.count("*").alias("homes"))
    # A home row alone at its anchor still has to wait for copies of others, so it stays.
    met = written(rows.join(shuffled(homes), "anchor"))
    other = F.when(F.shiftright("anchor", ANCHOR_BITS) == 0, F.shiftright("fp", 32)).otherwise(F.col("fp"))
    bytes_ = F.array(*[F.shiftright(other, 8 * k).bitwiseAND(255) + 256 * k for k in range(4)])
    keyed = met.withColumn("part", F.explode(F.when(F.col("homes") > crowded, bytes_).otherwise(F.array(F.lit(-1).cast("long")))))
    left = keyed.where("home").select("anchor", "part", F.col("fp").alias("one"))
    right = keyed.select("anchor", "part", F.col("fp").alias("two"))
    near = (F.col("one") != F.col("two")) & (F.bit_count(F.col("one").bitwiseXOR(F.col("two"))) <= THRESHOLD)
    pairs = left.join(shuffled(right), ["anchor", "part"]).where(near)
    return pairs.select(F.least("one", "two").alias("low"), F.greatest("one", "two").alias("high")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node that has an edge."""
    edges = written(edges)
    both = written(edges.union(edges.select(F.col("high").alias("low"), F.col("low").alias("high"))).toDF("node", "next"))
    labels = written(both.groupBy("node").agg(F.least("node", F.min("next")).alias("label")))
    while True:
        heard = both.join(shuffled(labels.select(F.col("node").alias("next"), F.col("label").alias("heard"))), "next")
        least = heard.groupBy("node").agg(F.min("heard").alias("heard"))
        spread = labels.join(shuffled(least), "node").select("node", F.col("label").alias("was"), F.least("label", "heard").alias("label"))
        # Where the label points now.
        ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("ahead"))
        jumped = written(spread.join(shuffled(ahead), "label", "left").select("node", "was", F.least("label", F.coalesce("ahead", "label")).alias("label")))
        labels = jumped.select("node", "label")
        if jumped.where("label != was").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, text: str = "text", crowded: int = CROWDED) -> DataFrame:
    """(doc_id, fingerprint, component_id): the smallest doc_id reachable over links of at most three bits."""
    prints = written(fingerprints(docs, text))
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    linked = components(links(classes, crowded)).withColumnRenamed("node", "fp")
    grouped = written(linked.join(shuffled(classes), "fp"))
    smallest = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    found = grouped.join(shuffled(smallest), "label").select("fp", "component_id")
    labels = written(
        classes.join(shuffled(found), "fp", "left").select("fp", "n", F.coalesce("component_id", "first").alias("component_id"))
    )
    total = prints.count()
    # At most HOT_SHARE rows, as each stands for that share of all rows.
    hot = labels.where(F.col("n") * HOT_SHARE >= total).select("fp", "component_id")
    by_hot = prints.join(F.broadcast(hot), "fp")
    rest = prints.join(F.broadcast(hot), "fp", "left_anti").join(shuffled(labels.where(F.col("n") * HOT_SHARE < total)), "fp")
    return by_hot.unionByName(rest.select(*by_hot.columns)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, one document of each group of near-duplicates: the one with the smallest doc_id.

    Rows that repeat a doc_id count as one document, of which the first by text stays; rows without a doc_id stay.
    """
    keepers = near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.select("doc_id", whole_row(docs)).join(shuffled(keepers), "doc_id", "left_semi")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("_row.text"))
    kept = kept.withColumn("place", first).where("place = 1").select("_row.*")
    return kept.unionByName(docs.where("doc_id is null"))
