"""Byte-pair encoding and decoding with a word-based vocabulary, by a contiguous rank array per word.

A text is cut at special tokens, brought to NFC and lower case and cut into short words. A word's parts and the ranks
of adjacent pairs are two small lists side by side: scan the ranks for the minimum, delete that boundary, refresh the
two ranks next to it, until no pair can be merged. Words have some dozen parts, where such a scan beats a heap. A run of
letters without a space (a page in Thai or Chinese) is one word, and its scans would cost the square of its length: words
of more than ``LONGEST_SCANNED`` parts keep their pairs in a heap instead, with the same merges in the same order.

Every executor reads the vocabulary file once per Python worker. Words repeat, so each worker keeps the codes of up
to ``CACHED_WORDS`` words; the memo is emptied when it is full, so memory is bounded whatever the texts.

Null text counts as empty: no ids. Texts of any length are encoded whole, one row at a time.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_WORDS = 400_000
LONGEST_SCANNED = 256
# Two ids in one number: vocabularies have fewer than 2^20 entries.
SHIFT = 20
MASK = (1 << SHIFT) - 1
NO_PAIR = 1 << 60
ASCII_SPACE = regex.compile("[ \t-\r]+")
# Characters whose lower case depends on what is around them, or takes its own course: handled one by one.
FINAL_SIGMA = "Σ"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Codec:
    """Encoder and decoder for one vocabulary file in the tokenizers JSON format."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = [""] * (max([*vocab.values(), *self.specials.values()]) + 1)
        for text, i in (*vocab.items(), *self.specials.items()):
            self.token[i] = text
        (pattern,) = (p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        # rank and merged id of a pair, by the two ids
        self.pair = {
            vocab[a] << SHIFT | vocab[b]: rank << SHIFT | vocab[a + b]
            for rank, (a, b) in enumerate(map(tuple, model["merges"]))
        }
        marks = byte_characters()
        self.inner = [vocab.get(c) for c in marks]
        self.last = [vocab.get(c + end) for c in marks]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.memo: dict[str, tuple[int, ...]] = {}

    def word_ids(self, word: str) -> list[int]:
        """Ids of one word, by the contiguous rank array if it is short."""
        data = word.encode("utf-8", "surrogatepass")
        ids = [self.inner[b] for b in data[:-1]]
        ids.append(self.last[data[-1]])
        ids = [i for i in ids if i is not None]
        if len(ids) > LONGEST_SCANNED:
            return self.long_word_ids(ids)
        pair = self.pair.get
        ranks = [pair(a << SHIFT | b, NO_PAIR) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == NO_PAIR:
                break
            at = ranks.index(best)
            ids[at] = best & MASK
            del ids[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = pair(ids[at] << SHIFT | ids[at + 1], NO_PAIR)
            if at:
                ranks[at - 1] = pair(ids[at - 1] << SHIFT | ids[at], NO_PAIR)
        return ids

    def long_word_ids(self, ids: list[int]) -> list[int]:
        """The same merges by a heap of (rank, place) over linked parts; entries whose pair has changed are passed over."""
        pair, n = self.pair.get, len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(rank, at) for at, (a, b) in enumerate(zip(ids, ids[1:])) if (rank := pair(a << SHIFT | b)) is not None]
        heapify(heap)
        while heap:
            rank, at = heappop(heap)
            right = after[at]
            # A part that was merged into its left neighbour has the id -1.
            if right == n or ids[at] < 0 or pair(ids[at] << SHIFT | ids[right]) != rank:
                continue
            ids[at], ids[right] = rank & MASK, -1
            after[at] = right = after[right]
            if right < n:
                before[right] = at
            for left, other in ((before[at], at), (at, right)):
                if left >= 0 and other < n and (rank := pair(ids[left] << SHIFT | ids[other])) is not None:
                    heappush(heap, (rank, left))
        return [i for i in ids if i >= 0]

    def normalized(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        return text.replace(FINAL_SIGMA, "σ").lower()

    def chunk_ids(self, chunk: str) -> tuple[int, ...]:
        """Ids of a piece of normalised text that no word crosses."""
        return tuple(i for w in self.words.findall(chunk) for i in self.word_ids(w))

    def encode(self, text: str | None) -> array:
        """Ids of a whole text; special tokens written in it count as such."""
        ids = array("I")
        if not text:
            return ids
        pieces = self.cut.split(text) if self.cut and "<|" in text else [text]
        memo = self.memo
        for piece in pieces:
            if piece in self.specials:
                ids.append(self.specials[piece])
                continue
            for chunk in ASCII_SPACE.split(self.normalized(piece)) if piece else ():
                found = memo.get(chunk)
                if found is None:
                    found = self.chunk_ids(chunk)
                    if len(memo) >= CACHED_WORDS:
                        memo.clear()
                    if len(chunk) < 64:
                        memo[chunk] = found
                ids.extend(found)
        return ids

    def decode(self, ids) -> str:
        """The tokens side by side, as the vocabulary has no decoder of its own."""
        token = self.token
        return " ".join([token[i] for i in ids])


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(df: DataFrame, path: str, text: str = "text", output: str = "ids") -> DataFrame:
    """Add the ids of ``text`` as an array. A column called ``output`` is replaced."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([codec(path).encode(t) for t in batch], dtype=object)

    return df.withColumn(output, ids(F.col(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """Add the text of an array of ids; null ids give null."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if x is None else codec(path).decode(x) for x in batch], dtype=object)

    return df.withColumn(output, texts(F.col(ids)))


def code_digests(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(all columns but the text, n_tokens, ids_sha256, decoded_sha256): encodes, decodes from the ids, keeps digests.

    Both steps happen where the text is, so ids of long texts never travel.
    """
    kept = [c for c in df.columns if c not in (text, "n_tokens", "ids_sha256", "decoded_sha256")]
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"

    @F.pandas_udf(schema)
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(path)
        numbers = [str(i) for i in range(len(own.token))]
        for batch in batches:
            rows = []
            for t in batch:
                ids = own.encode(t)
                written = " ".join([numbers[i] for i in ids])
                rows.append((
                    len(ids),
                    hashlib.sha256(written.encode()).hexdigest(),
                    hashlib.sha256(own.decode(ids).encode("utf-8", "surrogatepass")).hexdigest(),
                ))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    found = df.select(*kept, digests(F.col(text)).alias("_digests"))
    return found.select(*kept, "_digests.*")
