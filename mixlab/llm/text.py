"""Words and word hashes of whole Arrow batches, in numpy.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``; these are ASCII, so the cut is the
same in bytes and in characters. Hashes are 64 bits wide: a polynomial over the bytes (or
over the word hashes) modulo 2**64, then mixed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
_BLOCK = 1 << 18

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, at least ``n`` of them."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _powers[base] = known
    return known


_kept: dict[str, object] = {}


def keep(name: str, make: Callable[[], object]) -> object:
    """What ``make`` returns, kept by this Python worker for its next tasks, until ``give_back``."""
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def give_back(but: str | None = None) -> None:
    """Free the tables that this Python worker keeps, except that named ``but``, and return what is free to the system.

    Workers outlive stages: without this, what one operator kept stays beside the next one's.
    """
    for name in [n for n in _kept if n != but]:
        del _kept[name]
    _powers.clear()
    pa.default_memory_pool().release_unused()
    trim()


def trim() -> None:
    """Return what this process has freed to the system; cheap beside a chunk's work."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # no such call here
        pass


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of ``values[start:end]`` for each pair, by prefix sums."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(_BASE, n)[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_BASE_INVERSE, n + 1)[starts])


def string_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if len(column) == 0:
        offsets = np.zeros(1, np.int64)
    return data, offsets


class Words:
    """The words of consecutive documents: byte spans, and ``first[i]:first[i + 1]`` for document i."""

    separators = ~_IS_WORD

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> None:
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        word = ~self.separators[data]
        before = np.zeros(len(data), bool)
        before[1:] = word[:-1]
        edges = offsets[:-1]
        before[edges[edges < len(data)]] = False
        self.starts = np.flatnonzero(word & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = word[1:]
        edges = offsets[1:] - 1
        after[edges[edges >= 0]] = False
        self.ends = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        """One hash per word, in blocks, so that the power table stays small."""
        out = np.empty(len(self.starts), np.uint64)
        low = 0
        while low < len(out):
            base = self.starts[low]
            high = np.searchsorted(self.starts, base + _BLOCK)
            part = _BYTE[self.data[base : self.ends[high - 1]]]
            out[low:high] = rolling(part, self.starts[low:high] - base, self.ends[low:high] - base)
            low = high
        return mix(out ^ (self.ends - self.starts).astype(np.uint64))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def chunks(batch: pa.RecordBatch, text: str, size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batch of about ``size`` bytes (one document at least), with bytes and offsets of the texts."""
    data, offsets = string_buffers(batch.column(text))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1)
        high = min(high, batch.num_rows)
        yield batch.slice(low, high - low), data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
