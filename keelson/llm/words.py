"""Words and their hashes, for whole Arrow columns at a time.

A word is a maximal run of bytes other than space and \\t\\n\\v\\f\\r; UTF-8 never uses those
bytes inside a character. Hashes are 64 bits: a polynomial over random byte values, then mixed. Two
different words or shingles share a hash with odds of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21  # texts worked on at a time; a longer text is one chunk

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUES[_SPACE] = 0
_LOWER = _VALUES.copy()
_LOWER[65:91] = _VALUES[97:123]
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEPS = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        n = max(n, CHUNK_BYTES + 1)
        out = []
        for base in (_BASE, _BASE_INVERSE):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        _powers = tuple(out)
    return _powers


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows and of the end) over a string column."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32) if len(column) else np.zeros(1, np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


class Words:
    """The words of a chunk: byte ranges, the first word of each row (and the end), hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, hashed: bool = True):
        n = len(data)
        self.data, self.offsets = data, offsets
        if n == 0:
            self.starts = self.ends = np.zeros(0, np.int64)
            self.first = np.zeros(len(offsets), np.int64)
            self.hashes = np.zeros(0, np.uint64)
            return
        full = ~_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        edge[1:n] |= ~full[:-1]
        self.starts = np.flatnonzero(full & edge[:-1])
        edge[:] = False
        edge[offsets] = True
        edge[1:n] |= ~full[1:]
        self.ends = np.flatnonzero(full & edge[1:]) + 1
        self.first = np.searchsorted(self.starts, offsets)
        if hashed:
            up, down = powers(n + 1)
            run = np.zeros(n + 1, np.uint64)
            np.cumsum((_LOWER if lower else _VALUES)[data] * up[:n], out=run[1:])
            sums = (run[self.ends] - run[self.starts]) * down[self.starts]
            self.hashes = mix(sums + (self.ends - self.starts).astype(np.uint64))

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, starts here) for the k words from each word on; false where the row ends before."""
        n = len(self.hashes)
        total = np.zeros(n, np.uint64)
        for j in range(min(k, n)):
            total[: n - j] += self.hashes[j:] * _STEPS[j]
        end = np.repeat(self.first[1:], np.diff(self.first))
        return mix(total), np.arange(n) + k <= end

    def shingle_sets(self, k: int) -> list[np.ndarray]:
        """Per row the sorted distinct hashes of its k-word shingles.

        A row with fewer words has one shingle, all of them; one without words has none.
        """
        grams, whole = self.grams(k)
        out = []
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(grams[a : b - k + 1]))
            elif b > a:
                own = self.hashes[a:b]
                out.append(mix(np.array([int((own * _STEPS[: b - a]).sum(dtype=np.uint64))], np.uint64) + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out
