"""Words and word shingles of a batch of texts as numpy arrays, without a Python loop over words.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. Both are ASCII, so
working on UTF-8 bytes gives the same words as working on characters. Hashes have 64 bits and
depend on the words alone, so they agree between tasks and runs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
GRAM_BASE = np.uint64(0xD6E8FEB86659FD93)
BLOCK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the row offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _powers(n: int) -> np.ndarray:
    out = np.empty(max(n, 1), dtype=np.uint64)
    out[0] = 1
    filled = 1
    while filled < len(out):
        step = min(filled, len(out) - filled)
        factor = out[filled - 1 : filled] * WORD_BASE
        out[filled : filled + step] = out[:step] * factor
        filled += step
    return out


class Words:
    """Words of a batch: hash and byte span of each, and which words belong to which row."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw, self.offsets = raw, offsets
        inside = ~_SPACE[raw]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cuts = offsets[1:-1]
        cuts = cuts[cuts < len(raw)]
        begins[cuts] |= inside[cuts]
        self.starts = np.flatnonzero(begins)
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        before = offsets[1:-1]
        before = before[before > 0] - 1
        ends[before] |= inside[before]
        self.ends = np.flatnonzero(ends) + 1
        self.rows = np.searchsorted(self.starts, offsets)
        self.hash = self._hash()

    def _hash(self) -> np.ndarray:
        """Polynomial hashes of the words, computed over blocks of neighbouring words."""
        out = np.zeros(len(self.starts), np.uint64)
        if not len(out):
            return out
        powers = _powers(int((self.ends - self.starts).max()))
        edges = np.searchsorted(self.starts, np.arange(0, len(self.raw), BLOCK_BYTES))
        for a, b in zip(edges, [*edges[1:], len(out)], strict=True):
            if a == b:
                continue
            starts, lengths = self.starts[a:b], self.ends[a:b] - self.starts[a:b]
            at = np.concatenate([[0], np.cumsum(lengths)])
            inner = np.arange(at[-1]) - np.repeat(at[:-1], lengths)
            byte = _LOWER[self.raw[np.repeat(starts, lengths) + inner]].astype(np.uint64)
            out[a:b] = np.add.reduceat((byte + np.uint64(1)) * powers[inner], at[:-1])
        return mix(out)

    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words and their row offsets; a shorter row gives one run."""
        counts = self.counts()
        n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
        offsets = np.concatenate([[0], np.cumsum(n)])
        if not offsets[-1]:
            return np.zeros(0, np.uint64), offsets
        first = np.repeat(self.rows[:-1] - offsets[:-1], n) + np.arange(offsets[-1])
        short = np.repeat(counts < size, n)
        value = np.zeros(len(first), np.uint64)
        limit = np.repeat(self.rows[1:], n) if short.any() else None
        for k in range(size):
            at = first + k
            if limit is None:
                value = value * GRAM_BASE + self.hash[at]
            else:
                live = at < limit
                value[live] = value[live] * GRAM_BASE + self.hash[at[live]]
        return mix(value), offsets


def words_of(column: pa.Array) -> Words:
    return Words(*text_bytes(column))


def distinct_per_row(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row."""
    values = values.copy()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    starts = offsets[:-1]
    keep[starts[starts < len(values)]] = True
    return values[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def set_hash(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 128-bit hash for each row's set of distinct values, as two columns; empty sets give 0."""
    out = np.zeros((len(offsets) - 1, 2), np.uint64)
    full = np.diff(offsets) > 0
    if full.any():
        at = offsets[:-1][full]
        out[full, 0] = np.add.reduceat(mix(values), at)
        out[full, 1] = np.add.reduceat(mix(values ^ GRAM_BASE), at)
    return out
