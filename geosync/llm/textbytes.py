"""Texts of an Arrow batch as one byte array: words, lines and hashes of substrings for all texts at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is handled alone.
SLICE_BYTES = 1 << 18

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    up = _powers(BASE, 1)
    down = _powers(INVERSE, 1)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, 2 * SLICE_BYTES)
            cls.up, cls.down = _powers(BASE, n), _powers(INVERSE, n)
        return cls.up, cls.down


class Hashes:
    """64-bit hashes of substrings in constant time each, from one pass over the bytes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _Powers.of(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = (ends - starts).astype(np.uint64)
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + lengths * BASE)


@dataclass
class Slice:
    """Some consecutive texts of a batch: rows ``lo`` to ``hi``, their bytes, and where each text starts and ends."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return self.hi - self.lo

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each text has."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of each maximal run of flagged bytes; no run goes from one text into the next."""
        n = len(inside)
        cut = np.zeros(n + 1, bool)
        cut[self.offsets] = True
        before = np.zeros(n + 1, bool)
        before[1:] = inside
        after = np.zeros(n + 1, bool)
        after[:n] = inside
        starts = np.flatnonzero(after & (~before | cut))
        ends = np.flatnonzero(before & (~after | cut))
        return starts, ends, self.text_of(starts)

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, side="right") - 1


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a string column in order, null as empty, in slices of about ``most`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield Slice(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def group_starts(text: np.ndarray, n: int) -> np.ndarray:
    """Where the items of each of ``n`` texts begin, and the end: items are sorted by text."""
    return np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))]).astype(np.int64)


def shingle_hashes(words: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash and the text of every run of ``size`` words within a text, in order."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * BASE + words[k : k + n]
    whole = text[:n] == text[size - 1 :]
    return mix(total[whole]), text[:n][whole]
