"""Packing documents into sequences: first-fit decreasing on a tournament tree, in randomised groups.

Documents become ids where their text is; only (document, start, length, checksum) rows travel. A document longer than
a sequence is cut into full sequences and a remainder. Pieces are dealt into groups by a hash, about ``GROUP_PIECES`` each, and each group is packed on its own: pieces in falling order of length, each into the
first open sequence with room. The tree holds, for every node, the largest free room below it, so the first fitting
sequence is found by walking down from the root. A group holds only numbers, and the number of groups grows with the
input, so no task grows. The same rows give the same groups and the same sequences in any run.

Null text counts as empty; every document ends with ``end_id``, so an empty one has one id. Rows that repeat a doc_id
are packed as documents of their own.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from opinia.llm.bpe import byte_characters
from opinia.llm.storage import written
from opinia.llm.words import blocks, text_bytes, words_of

SEQUENCE = 4096
END_ID = 2
# Enough pieces for nearly full sequences, few enough for one small task.
GROUP_PIECES = 2048
# What a worker's memo may hold, with so many bytes for an entry besides its ids.
MEMO_BYTES = 24 << 20
ENTRY_BYTES = 14
# Entries that wait before they are sorted into the rest of the memo.
RECENT_WORDS = 1 << 15
# Longer stretches without a space are not kept.
LONGEST_CACHED = 64
MARKS = frozenset(".,;:!?")
# Letters whose lower case is not one letter, or depends on what is around them.
ODD_CASE = frozenset("Σİ")
# By byte: whether it is a mark, a letter, and its lower case.
MARK_BYTES = np.isin(np.arange(256), [ord(m) for m in MARKS]).astype(np.int64)
LATIN_LEAD = 0xC3
LETTER_BYTES = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), LATIN_LEAD])
LOWERED = np.arange(256, dtype=np.uint8) + 32 * np.isin(np.arange(256), range(65, 91)).astype(np.uint8)
# The same behind the lead byte, where the signs for times and divided by are no letters.
LATIN_LETTERS = np.isin(np.arange(256), [b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)])
LATIN_LOWERED = np.arange(256, dtype=np.uint8) + 32 * np.isin(np.arange(256), range(0x80, 0x9F)).astype(np.uint8)
PIECE = "start long, length long, ids_crc32 long, doc_tokens long"
# What all special tokens begin with.
SPECIAL_MARK = b"<|"


def gathered(ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Runs of ``ids`` behind each other."""
    ends = np.cumsum(size)
    return ids[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - size), size)]


class Memo:
    """Ids of words by their 64-bit hashes, as arrays: sorted hashes, and where the ids of each lie among all."""

    def __init__(self) -> None:
        self.hashes, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint16)
        self.ids = np.zeros(0, np.uint32)

    def __len__(self) -> int:
        return len(self.hashes)

    @property
    def held(self) -> int:
        return ENTRY_BYTES * len(self.hashes) + self.ids.nbytes

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each one's entry, -1 where there is none."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def runs(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of entries."""
        size = self.size[places].astype(np.int64)
        return gathered(self.ids, self.begin[places].astype(np.int64), size), size

    def add(self, hashes: np.ndarray, begin: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Entries that are not there yet."""
        every = np.concatenate([self.hashes, hashes])
        order = np.argsort(every, kind="stable")
        begin = begin.astype(np.uint32) + np.uint32(len(self.ids))
        self.hashes, self.begin = every[order], np.concatenate([self.begin, begin])[order]
        self.size = np.concatenate([self.size, size.astype(np.uint16)])[order]
        self.ids = np.concatenate([self.ids, ids])


class WordEncoder:
    """A tokenizers file asked once for each different word: its results for words between spaces are kept in arrays, by a 64-bit
    hash of the word."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.specials = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.marks = {"": b""} | {mark: self.whole(mark) for mark in MARKS}
        self.byte_characters = byte_characters()
        self.byte_codes = np.array([ord(self.byte_characters[b]) for b in range(256)], "<u4")
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.memo, self.recent = Memo(), Memo()
        if not all(s.startswith(SPECIAL_MARK.decode()) for s in self.specials):
            raise ValueError("special tokens of another kind")

    def whole(self, text: str) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def letters(self, word: str) -> bytes | None:
        """Ids of a word of letters, which the model can be asked for as it is; None for any other word."""
        if not word.isalpha():
            return None
        if word.isascii():
            known = word.lower()
        elif unicodedata.is_normalized("NFC", word) and ODD_CASE.isdisjoint(word):
            characters = self.byte_characters
            known = "".join([characters[b] for b in word.lower().encode("utf-8", "surrogatepass")])
        else:
            return None
        packed = self.id_bytes
        return b"".join([packed[t.id] for t in self.model.tokenize(known)])

    def new_codes(self, words: list[str]) -> list[bytes]:
        """Ids of words that white space cuts off."""
        found: list[bytes | None] = []
        odd = []
        for word in words:
            # A mark behind a word of letters never joins it.
            bare, mark = (word[:-1], word[-1]) if word[-1:] in MARKS else (word, "")
            code = self.letters(bare) if bare else b""
            if code is None:
                odd.append(word)
            found.append(None if code is None else code + self.marks[mark])
        if odd:
            # The rest all at once, as the call costs more than the word.
            rest = iter(self.tokenizer.encode_batch_fast(odd, add_special_tokens=False))
            found = [b"".join([self.id_bytes[i] for i in next(rest).ids]) if c is None else c for c in found]
        return found

    def fresh_codes(self, data: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """Ids of words that the memo has not. Words of letters up to U+00FF, with or without a mark behind, are told apart and put
        in lower case as arrays; the others one by one."""
        bare = last - MARK_BYTES[data[last - 1]]
        # Letters from U+00C0 on: this byte, then one more.
        second = np.concatenate([[False], data[:-1] == LATIN_LEAD])
        letter = np.where(second, LATIN_LETTERS[data], LETTER_BYTES[data])
        letters = np.concatenate([[0], np.cumsum(letter, dtype=np.int32)])
        plain = (bare > first) & (letters[bare] - letters[first] == bare - first)
        found: list[bytes] = [b""] * len(first)
        at = np.flatnonzero(plain)
        lowered = np.where(second, LATIN_LOWERED[data], LOWERED[data])
        text = self.byte_codes[lowered].tobytes().decode("utf-32-le")
        tokenize, packed = self.model.tokenize, self.id_bytes
        marks = [self.marks[chr(b)] if m else b"" for b, m in zip(data[last[at] - 1].tolist(), (last > bare)[at].tolist())]
        for k, a, b, mark in zip(at.tolist(), first[at].tolist(), bare[at].tolist(), marks):
            found[k] = b"".join([packed[t.id] for t in tokenize(text[a:b])]) + mark
        rest = np.flatnonzero(~plain)
        if len(rest):
            whole = data.tobytes()
            words = [whole[a:b].decode("utf-8", "surrogatepass") for a, b in zip(first[rest].tolist(), last[rest].tolist())]
            for k, code in zip(rest.tolist(), self.new_codes(words)):
                found[k] = code
        return found

    def codes(self, data: np.ndarray, hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first id, number of ids) of different words of ``data``, from the memo where it has them."""
        begin, size = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        pools, n, missing = [], 0, np.arange(len(hashes))

        def put(at: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
            nonlocal n
            begin[at], size[at] = n + np.cumsum(sizes) - sizes, sizes
            pools.append(ids)
            n += len(ids)

        for memo in (self.memo, self.recent):
            places = memo.places(hashes[missing])
            known = places >= 0
            put(missing[known], *memo.runs(places[known]))
            missing = missing[~known]
        if len(missing):
            fresh = self.fresh_codes(data, first[missing], last[missing])
            sizes = np.array([len(code) for code in fresh], np.int64) // 4
            ids = np.frombuffer(b"".join(fresh), np.uint32)
            put(missing, ids, sizes)
            kept = last[missing] - first[missing] <= LONGEST_CACHED
            self.keep(hashes[missing][kept], sizes[kept], gathered(ids, (np.cumsum(sizes) - sizes)[kept], sizes[kept]))
        return np.concatenate(pools), begin, size

    def keep(self, hashes: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        self.recent.add(hashes, np.cumsum(size) - size, size, ids)
        if self.memo.held + self.recent.held > MEMO_BYTES:
            self.memo, self.recent = Memo(), Memo()
        elif len(self.recent) > RECENT_WORDS:
            self.memo.add(self.recent.hashes, self.recent.begin, self.recent.size, self.recent.ids)
            self.recent = Memo()

    def block(self, data: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """Ids of texts that lie side by side, as little-endian unsigned 32-bit numbers."""
        hashes, first, last, counts = words_of(data, starts)
        # Long words are not trusted to a hash: they get one of their own.
        long_ = np.flatnonzero(last - first > LONGEST_CACHED)
        hashes[long_] = np.arange(len(long_), dtype=np.uint64)
        _, chosen, at = np.unique(hashes, return_index=True, return_inverse=True)
        ids, begin, size = self.codes(data, hashes[chosen], first[chosen], last[chosen])
        # Each word's ids, from where its code begins.
        size = size[at]
        ids = gathered(ids, begin[at], size)
        bounds = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def packed(self, column: pa.Array) -> Iterator[bytes]:
        """Ids of every text of a column."""
        offsets, data = text_bytes(column)
        parts: list[bytes] = []
        for at, upto, low, high, begins, ends in blocks(offsets, data):
            part = data[low:high]
            if begins and ends:
                found = self.block(part, offsets[at:upto] - low)
                if SPECIAL_MARK in part.tobytes():
                    # Special tokens written in a text may have no white space around them.
                    for k, text in enumerate(column[at:upto].to_pylist()):
                        if text and any(s in text for s in self.specials):
                            found[k] = self.whole(text)
                yield from found
                continue
            parts = [] if begins else parts
            parts += self.block(part, np.zeros(1, np.int64))
            if ends:
                text = column[at].as_py()
                yield self.whole(text) if any(s in text for s in self.specials) else b"".join(parts)


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pieces(docs: DataFrame, path: str, text: str = "text", sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): full sequences of a document and its remainder."""
    end = end_id.to_bytes(4, "little")

    def cut(data: bytes) -> list[tuple[int, int, int, int]]:
        n = len(data) // 4
        return [
            (start, min(sequence, n - start), zlib.crc32(data[4 * start : 4 * (start + sequence)]), n)
            for start in range(0, n, sequence)
        ]

    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *StructType.fromDDL(PIECE).fields])
    arrow = to_arrow_schema(schema)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_encoder(path)
        for batch in batches:
            places, rows = [], []
            for k, data in enumerate(own.packed(batch.column(1))):
                found = cut(data + end)
                places += [k] * len(found)
                rows += found
            columns = [batch.column(0).take(pa.array(places, pa.int64())), *[pa.array(c, pa.int64()) for c in zip(*rows)]]
            if rows:
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.select("doc_id", text).mapInArrow(cut_up, schema)


class Rooms:
    """Tournament tree over the free room of open sequences; leaves are sequences in the order of opening."""

    def __init__(self, leaves: int, room: int) -> None:
        self.size = 1 << max(0, (leaves - 1).bit_length())
        self.best = [room] * (2 * self.size)

    def put(self, length: int) -> tuple[int, int]:
        """Take ``length`` from the first sequence with that much room: its number and the room it had."""
        node, best = 1, self.best
        while node < self.size:
            node *= 2
            if best[node] < length:
                node += 1
        had = best[node]
        best[node] = had - length
        place = node - self.size
        node //= 2
        while node:
            best[node] = max(best[2 * node], best[2 * node + 1])
            node //= 2
        return place, had


def first_fit_decreasing(lengths: list[int], room: int = SEQUENCE) -> list[tuple[int, int]]:
    """(sequence, offset) of each length; as many sequences as lengths are always enough."""
    rooms, placed = Rooms(len(lengths), room), [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        place, had = rooms.put(lengths[i])
        placed[i] = (place, room - had)
    return placed


def pack(docs: DataFrame, path: str, text: str = "text", sequence: int = SEQUENCE, end_id: int = END_ID, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece."""
    cut = written(pieces(docs, path, text, sequence, end_id))
    groups = -(-cut.count() // group_pieces) or 1
    hashed = F.xxhash64("doc_id", "start", "length", "ids_crc32", F.lit(0x9E37))
    dealt = cut.withColumn("group", F.pmod(hashed, F.lit(groups)))

    def pack_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        placed = first_fit_decreasing(rows["length"].tolist(), sequence)
        return rows.assign(
            sequence_id=(rows["group"].to_numpy() << 32) + [p for p, _ in placed], offset=[o for _, o in placed]
        ).drop(columns="group")

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return dealt.groupBy("group").applyInPandas(pack_group, schema)
