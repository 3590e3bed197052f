"""Words of many texts at a time: cut and hashed as arrays of bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
SEED = 42
# Bytes of text taken at a time.
BLOCK_BYTES = 1 << 20
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
BYTE_CODES = np.random.default_rng(SEED).integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
# ASCII letters count in lower case.
BYTE_CODES[65:91] = BYTE_CODES[97:123]
RADIX = 0x5851F42D4C957F2D
RADIX_INVERSE = pow(RADIX, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def column(base: int) -> np.ndarray:
        factors = np.full(n, base, np.uint64)
        factors[:1] = 1
        return np.cumprod(factors, dtype=np.uint64)

    return column(RADIX), column(RADIX_INVERSE)


def words_of(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, byte behind the last) of all words of texts that lie side by side, and the number of words of each
    text; ``starts`` says where texts begin. A word is a run of bytes without ASCII white space."""
    solid = ~SPACES[data]
    before = np.concatenate([[False], solid[:-1]])
    edges = starts[(starts > 0) & (starts < len(data))]
    before[edges] = False
    first = np.flatnonzero(solid & ~before)
    after = np.concatenate([(before & solid)[1:], [False]])
    last = np.flatnonzero(solid & ~after) + 1
    powers, inverses = _powers(max(BLOCK_BYTES, len(data)))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * powers[: len(data)], out=sums[1:])
    hashes = mix((sums[last] - sums[first]) * inverses[first] + (last - first).astype(np.uint64))
    ends = np.concatenate([starts[1:], [len(data)]])
    return hashes, first, last, np.searchsorted(first, ends) - np.searchsorted(first, starts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a column of texts; null counts as empty."""
    column = (column.fill_null("") if column.null_count else column).cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    return offsets, np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)


def blocks(offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, int, int, int, bool, bool]]:
    """(first text, text behind the last, first byte, byte behind the last, begins, ends) of blocks of bounded size: several
    whole texts, or a part of a long one, cut between words."""
    at, n = 0, len(offsets) - 1
    while at < n:
        low, high = int(offsets[at]), int(offsets[at + 1])
        if high - low <= BLOCK_BYTES:
            upto = max(at + 1, int(np.searchsorted(offsets, low + BLOCK_BYTES, side="right")) - 1)
            yield at, upto, low, int(offsets[upto]), True, True
            at = upto
            continue
        begins = True
        while low < high:
            cut = min(low + BLOCK_BYTES, high)
            while cut < high:
                spaces = np.flatnonzero(SPACES[data[low:cut]])
                if len(spaces):
                    cut = low + int(spaces[-1]) + 1
                    break
                cut = min(cut + BLOCK_BYTES, high)
            yield at, at + 1, low, cut, begins, cut == high
            begins, low = False, cut
        at += 1
