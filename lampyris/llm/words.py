"""Words and word hashes of a batch of texts, on the UTF-8 bytes of an Arrow column (numpy, no Python strings).

All word classes used here separate at ASCII bytes only, so they can be told apart byte by byte. A word's hash is a
64-bit polynomial over a random byte table, taken from running sums; shingle hashes mix five of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: Separators of license words: everything in ASCII but digits and lower-case letters.
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

SHINGLE = 5
_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SLOT = _RNG.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
#: A-Z to a-z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for positions below n."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        out = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps, dtype=np.uint64))
        _powers = (out[0], out[1])
    return _powers


class Texts:
    """Words of some texts: `start`, `end` (byte places), `hash`, and `first[i]:first[i + 1]`, the words of text i."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, separators: bytes, fold: bool = True, hashes: bool = True):
        inside = np.ones(256, bool)
        inside[list(separators)] = False
        if fold:
            data = FOLD[data]
        self.data, self.bounds = data, bounds
        flags = inside[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        begins = flags.copy()
        begins[1:] &= ~flags[:-1] | edge[1:-1]
        ends = flags.copy()
        ends[:-1] &= ~flags[1:] | edge[1:-1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, bounds)
        if hashes:
            up, down = _power(len(data) + 1)
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
            raw = (sums[self.end] - sums[self.start]) * down[self.start]
            self.hash = mix(raw + (self.end - self.start).astype(np.uint64) * np.uint64(_BASE))

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the five-word shingles of all texts and their bounds; a shorter text is one shingle, if it has words."""
        counts = np.diff(self.first)
        n = len(self.hash)
        full = max(0, n - SHINGLE + 1)
        rolled = np.zeros(full, np.uint64)
        for k in range(SHINGLE):
            rolled += self.hash[k : k + full] * _SLOT[k]
        per = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(np.int64))
        bounds = np.concatenate(([0], np.cumsum(per)))
        out = np.empty(bounds[-1], np.uint64)
        long = counts >= SHINGLE
        source = np.repeat(self.first[:-1][long] - bounds[:-1][long], per[long]) + _ranges(bounds[:-1][long], per[long])
        out[_ranges(bounds[:-1][long], per[long])] = mix(rolled[source])
        for i in np.flatnonzero(~long & (counts > 0)):
            own = self.hash[self.first[i] : self.first[i + 1]]
            out[bounds[i]] = mix((own * _SLOT[: len(own)]).sum(dtype=np.uint64)[None] + np.uint64(len(own)))[0]
        return out, bounds


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] places, then those of the next start."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 bounds of its rows; a null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8, int(bounds[-1] - bounds[0]), int(bounds[0])), bounds - bounds[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into parts of about `limit` bytes of text, so that working arrays stay small; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bounds = utf8(batch.column(column))[1]
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1)
            yield batch.slice(at, upto - at)
            at = upto
