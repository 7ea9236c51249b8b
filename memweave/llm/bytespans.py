"""Vectorised word and line spans over the UTF-8 bytes of an Arrow batch.

White space is the six ASCII characters ``[\\x20\\x09-\\x0D]``; their bytes
never occur inside a longer UTF-8 sequence, so words can be cut on the raw
bytes. Hashes are 64-bit polynomials over a random byte table: a span's hash
comes from two prefix sums, so every window of words costs a few array steps
however long it is.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Texts are handled in slices of about this many bytes, so the temporary
#: arrays of a task stay small however many rows an Arrow batch has.
SLICE_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
BYTE_LOWER = _BYTE[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POW = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of them."""
    if len(_POW["up"]) < n:
        size = max(n, 1 << 16)
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _POW[key] = np.cumprod(out, dtype=np.uint64)
    return _POW["up"], _POW["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64-bit result."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data, offs


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch at row borders into runs of about ``limit`` bytes: (first row, end row, bytes, offsets from 0).

    A single longer text makes a run of its own.
    """
    data, offs = buffers(col)
    row, n = 0, len(offs) - 1
    while row < n:
        end = int(np.searchsorted(offs, offs[row] + limit, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end, data[offs[row]:offs[end]], offs[row:end + 1] - offs[row]
        row = end


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words never cross a row border."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offs[1:-1]
    cut = cut[cut < len(data)]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends_at = cut[cut > 0] - 1
    last[ends_at] = inside[ends_at]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return start, end, row_of(start, offs)


def row_of(pos: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return np.searchsorted(offs, pos, side="right") - 1


class Hasher:
    """Hashes of byte spans of one slice."""

    def __init__(self, data: np.ndarray, table: np.ndarray = _BYTE):
        up, self.down = _powers(len(data) + 2)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[:len(data)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


class Sequences:
    """Hashes of runs of items (words, tokens) given by their own hashes."""

    def __init__(self, items: np.ndarray):
        up, self.down = _powers(len(items) + 2)
        self.items, self.up = items, up
        self.sums = np.zeros(len(items) + 1, np.uint64)
        np.cumsum(items * up[:len(items)], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Polynomial of items[start:end]; the first item has weight 1."""
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(np.uint64))

    def without(self, start: np.ndarray, end: np.ndarray, drop: np.ndarray) -> np.ndarray:
        """Hash of items[start:end] with item ``drop`` (an index in the run) left out; equals ``runs`` of that sequence."""
        head = self.raw(start, drop)
        tail = self.raw(drop + 1, end) * self.up[drop - start]
        return mix(head + tail + (end - start - 1).astype(np.uint64))


def windows(row: np.ndarray, size: int) -> np.ndarray:
    """Index of the first word of every window of ``size`` words that stays in one row."""
    if len(row) < size:
        return np.zeros(0, np.int64)
    return np.flatnonzero(row[size - 1:] == row[:len(row) - size + 1])


def counts_per_row(row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, minlength=n).astype(np.int64)


def ranges(lengths: np.ndarray) -> np.ndarray:
    """0..length-1 for every length, concatenated."""
    total = int(lengths.sum())
    out = np.arange(total, dtype=np.int64)
    return out - np.repeat(np.cumsum(lengths) - lengths, lengths)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def release_memory() -> None:
    """Give memory that a finished task no longer uses back to the system; a worker process outlives its tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)
