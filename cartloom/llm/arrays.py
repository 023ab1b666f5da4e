"""Texts as byte arrays: words, their hashes and k-word windows of many texts at once.

Everything works on the UTF-8 bytes of an Arrow string column, a few megabytes at a time, so that a
task's memory depends on the longest single text and not on its number of rows. Null texts are
empty. Hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 1 << 21
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
_BYTE_CODES = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64)


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Table over bytes: True where the byte belongs to a word. Bytes from 0x80 always do."""
    table = np.ones(256, bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


#: Words of `[^\x20\x09-\x0D]+`.
SPACED = separators((0x09, 0x0D), (0x20, 0x20))
#: Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z are lower-cased.
ALNUM = separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about `limit` bytes, or one longer row."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(n, max(high, low + 1))
        yield low, high
        low = high


_powers: dict[str, np.ndarray] = {}


def powers(n: int, base: np.uint64, name: str) -> np.ndarray:
    held = _powers.get(name)
    if held is None or len(held) < n:
        held = np.full(max(n, SLICE_BYTES + 1), base, U64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        if n <= SLICE_BYTES + 1:
            _powers[name] = held
    return held[:n]


class RangeHash:
    """Hashes of any byte ranges of one buffer: equal bytes have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTE_CODES[data] * powers(len(data), _BASE, "up"), out=self.sums[1:])
        self.back = powers(len(data) + 1, _INVERSE, "down")

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(h + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words in text order; `row` counts from the slice's first row, `bounds[r]:bounds[r + 1]` are row r's words."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool = False) -> Words:
    """Words of every row of a slice; `offsets` start at 0. Words never cross rows."""
    if lower:
        data = _LOWER[data]
    n = len(data)
    inside = table[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < n]
    first[at] = inside[at]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:] - 1
    ends = ends[ends >= 0]
    last[ends] = inside[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return Words(row, start, end, RangeHash(data)(start, end), bounds)


def windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every window of k words within a row."""
    n = len(words.row) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    h = np.zeros(n, U64)
    for j in range(k):
        h = h * U64(0xC2B2AE3D27D4EB4F) + words.hash[j : j + n]
    at = np.flatnonzero(words.row[:n] == words.row[k - 1 :])
    return at, mix(h[at] + U64(k))
