"""Words, windows and packed messages over Arrow text columns, as numpy arrays.

A text column is seen as one byte buffer with bounds, so no Python object is made per word. A word
hash is a polynomial over a random table of byte values modulo 2**64, and a window hash one over
word hashes; both end in a mixer.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
_PIECE = 1 << 20
_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4D


def release() -> None:
    """Give freed memory back to the system. Allocators keep what numpy and Arrow let go, and Python
    workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A mask of byte values; ranges include both ends."""
    mask = np.zeros(256, bool)
    for low, high in ranges:
        mask[low : high + 1] = True
    return mask


#: What separates words. Bytes from 0x80 on are parts of letters.
WHITE_SPACE = byte_set((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


LOWER = lowered()


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            self.up, self.down = (self._series(b, n) for b in (self.base, self.inverse))
        return self.up, self.down

    @staticmethod
    def _series(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


_BYTE_POWERS, _WORD_POWERS = _Powers(_BASE), _Powers(_WORD_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a new array)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def text_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its row bounds; null counts as empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most ``limit`` bytes (one row at least): from, to, bytes, bounds."""
    data, bounds = text_view(column)
    low, rows = 0, len(bounds) - 1
    while low < rows:
        high = int(np.searchsorted(bounds, bounds[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high, data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
        low = high


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each row, and the end
    hashes: np.ndarray

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def window_ok(self, k: int) -> np.ndarray:
        """For each word, whether ``k`` words from it on lie in its row."""
        ends = np.repeat(self.first[1:], np.diff(self.first))
        return np.arange(len(self.starts)) + k <= ends


def find_words(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray, fold: np.ndarray | None = None) -> Words:
    """Maximal runs of non-separator bytes within each row; ``fold`` maps bytes before hashing."""
    inside = ~separators[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    opens[inner] = inside[inner]
    closes[inner - 1] = inside[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    values = _BYTE_VALUES if fold is None else _BYTE_VALUES[fold]
    return Words(starts, ends, np.searchsorted(starts, bounds), _hash_spans(data, starts, ends, values))


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        base = starts[low]
        high = max(int(np.searchsorted(ends, base + _PIECE, side="right")), low + 1)
        n = int(ends[high - 1] - base)
        up, down = _BYTE_POWERS.get(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data[base : base + n]] * up[:n], out=sums[1:])
        out[low:high] = (sums[ends[low:high] - base] - sums[starts[low:high] - base]) * down[starts[low:high] - base]
        low = high
    return mix(out)


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` consecutive values, row bounds not minded."""
    count = max(len(hashes) - k + 1, 0)
    out = np.empty(count, np.uint64)
    for low in range(0, count, _PIECE):
        high = min(low + _PIECE, count)
        part = hashes[low : high + k - 1]
        up, down = _WORD_POWERS.get(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        out[low:high] = (sums[k:] - sums[:-k]) * down[: high - low]
    return mix(out)


def strings(data: np.ndarray, bounds: np.ndarray, kind: pa.DataType = pa.string()) -> pa.Array:
    """A string or binary column over bytes and bounds."""
    if len(data) >= 1 << 31:
        raise ValueError("over 2 GiB of text in one slice")
    offsets = np.ascontiguousarray(bounds, np.int32)
    return pa.Array.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of spans, one after another, and their bounds."""
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    index = np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], lengths)
    return data[index], bounds
