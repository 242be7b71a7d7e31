"""Blocks of texts as numpy byte arrays, and the word, line and hash helpers that work on whole blocks.

Inside a Spark task, texts arrive as Arrow string arrays. Their bytes lie one after the other already, so words and
hashes of many texts are found with a few array operations instead of a Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
U64 = np.uint64
_RADIX = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but digits and small letters.
NON_WORD = np.zeros(256, bool)
NON_WORD[:0x80] = True
NON_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class TextBlock:
    """Consecutive texts: bytes, and where each text starts and ends. A null text is an empty one with ``valid`` false."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, valid: np.ndarray):
        self.data, self.offsets, self.valid = data, offsets, valid
        self.n = len(offsets) - 1

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode("utf-8", "replace")

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sums of ``flags`` (one per byte) by text."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, TextBlock]]:
    """(row of the first text, block) with about ``limit`` bytes a block, one text at least."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    valid = ~np.asarray(column.is_null()) if column.null_count else np.ones(n, bool)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        part = offsets[row : end + 1]
        yield row, TextBlock(data[part[0] : part[-1]], part - part[0], valid[row:end])
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(U64, copy=True)
    shifted = np.empty_like(x)
    x ^= np.right_shift(x, U64(30), out=shifted)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, U64(27), out=shifted)
    x *= U64(0x94D049BB133111EB)
    x ^= np.right_shift(x, U64(31), out=shifted)
    return x


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _RADIX, U64), np.full(size, pow(_RADIX, -1, 1 << 64), U64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hashes`` takes the hash of any span from them."""
    up, _ = _powers(max(BLOCK_BYTES * 2, 1 << max(1, len(data)).bit_length()))
    out = np.zeros(len(data) + 1, U64)
    values = np.take(_BYTE_VALUES, data)
    values *= up[: len(data)]
    np.cumsum(values, out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], equal for equal bytes wherever they lie."""
    _, down = _powers(max(BLOCK_BYTES * 2, 1 << max(1, len(sums) - 1).bit_length()))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def window_hashes(sums: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    """``span_hashes`` from each place of ``at`` (by default every byte) to the place ``size`` further on."""
    n = max(0, len(sums if at is None else at) - size)
    _, down = _powers(max(BLOCK_BYTES * 2, 1 << max(1, len(sums) - 1).bit_length()))
    if at is not None:
        sums = sums[at]
    out = sums[size:] - sums[:n]
    out *= down[:n] if at is None else down[at[:n]]
    out += U64(size) if at is None else (at[size:] - at[:n]).view(U64)
    return mix(out)


class Words:
    """The words of a block: spans, the text of each, the words of text i being ``bounds[i]:bounds[i+1]``."""

    def __init__(self, block: TextBlock, separators: np.ndarray, data: np.ndarray | None = None):
        data = block.data if data is None else data
        inside = ~separators[data]
        first = np.zeros(len(data) + 1, bool)
        first[block.offsets] = True
        first[-1] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | first[1:-1]
        ends = inside
        ends = ends.copy()
        ends[:-1] &= ~inside[1:] | first[1:-1]
        self.starts, self.ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.starts, block.offsets)
        self.counts = np.diff(self.bounds)
        self.owner = np.repeat(np.arange(block.n), self.counts)
        self.n = len(self.starts)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        return span_hashes(prefix_hashes(data), self.starts, self.ends)

    def windows(self, size: int) -> np.ndarray:
        """Positions at which ``size`` words of one text start."""
        if self.n < size:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.owner[: self.n - size + 1] == self.owner[size - 1 :])

    def cover(self, at: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        """Which words lie in one of the spans of ``size`` words that start ``at``."""
        change = np.zeros(self.n + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + size, -1)
        return np.cumsum(change[:-1]) > 0


def gram_hashes(words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` words from each position on."""
    out = np.full(len(at), size, U64)
    for k in range(size):
        out = out * U64(0xD6E8FEB86659FD93) + words[at + k]
        out ^= out >> U64(32)
    return mix(out)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys)
    held = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = held[1:] == held[:-1]
    out = np.empty(len(keys), bool)
    out[order] = same[1:] | same[:-1]
    return out
