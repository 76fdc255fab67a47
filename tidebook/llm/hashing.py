"""Vectorised hashes of byte ranges, words and word shingles, for use inside Arrow tasks.

A task handles some hundred kB of text at a time, whatever the size of its Arrow batches, so that its
memory does not follow the length of texts or batches (one very long text is a group of its own).
All hashes are fixed functions of the bytes: every executor and every run gives the same values.
Words are hashed eight bytes at a time through a finaliser that mixes all bits, very long ones by BLAKE2b.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15
GROUP_BYTES = 400_000
#: Ranges above so many bytes are hashed one by one.
LONG = 512


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(31))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    x *= U(0xA0761D6478BD642F)
    x ^= x >> U(32)
    return x


_FIRST = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def range_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray, long: int = LONG) -> np.ndarray:
    """64-bit hashes of byte ranges, a function of their bytes alone."""
    size = stop - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    h = mix((size.astype(np.uint64) + U(1)) * U(BASE))
    h = mix(h ^ (at[start] & _FIRST[np.minimum(size, 8)]))
    live = np.flatnonzero((size > 8) & (size <= long))
    k = 8
    while len(live):
        left = size[live] - k
        h[live] = mix(h[live] ^ (at[start[live] + k] & _FIRST[np.minimum(left, 8)]))
        live = live[left > 8]
        k += 8
    for i in np.flatnonzero(size > long).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : stop[i]].tobytes(), digest_size=8).digest(), "little")
    return h


@lru_cache(1)
def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * U(BASE))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i below n; a table of one usual group is kept."""
    return _powers(n) if n <= 1 << 20 else _powers.__wrapped__(n)


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE, dtype=np.uint64), np.full(n, pow(BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Rolling:
    """Hash of any range of some bytes, in constant time each.  Equal ranges have equal hashes; unequal ones may meet (the hash is
    a polynomial modulo 2 ** 64), so it serves to find candidates only."""

    def __init__(self, data: np.ndarray):
        self.n = len(data)
        size = 1 << max(20, int(self.n).bit_length())
        up, self.down = powers(size)
        self.sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(byte_values()[data] * up[: self.n], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]


def groups(batch: pa.RecordBatch, column: int, limit: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about limit bytes in the text column."""
    sizes = np.diff(offsets_of(batch.column(column)))
    if not len(sizes):
        return
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def offsets_of(text: pa.Array) -> np.ndarray:
    """Byte offsets of a string column without nulls, from 0."""
    wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
    raw = np.frombuffer(text.buffers()[1], dtype=np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    return raw - raw[0]


def bytes_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and the offsets of its rows in them."""
    wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
    raw = np.frombuffer(text.buffers()[1], dtype=np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = text.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[raw[0] : raw[-1]], raw - raw[0]


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_at(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words [^\\x20\\x09-\\x0D]+ of all rows, A-Z lower-cased: all bytes, the words' bounds in them, their hashes,
    and the rows' bounds in the words."""
    data, rows = bytes_of(text)
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return data, none, none, np.zeros(0, dtype=np.uint64), np.zeros(len(text) + 1, dtype=np.int64)
    data = _LOWER[data]
    solid = ~_BLANK[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    at = rows[1:-1]
    at = at[(at > 0) & (at < len(data))]
    first[at] = solid[at]  # a row's first byte never goes on with the row before
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    ends[at - 1] = solid[at - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(ends) + 1
    return data, start, stop, range_hashes(data, start, stop), np.searchsorted(start, rows)


def words(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, and the rows' bounds in them."""
    _, _, _, hashes, rows = words_at(text)
    return hashes, rows


def shingle_sets(text: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Each row's sorted distinct n-word shingles; fewer words make one, no words none."""
    w, rows = words(text)
    if len(w) >= n:
        h = np.zeros(len(w) - n + 1, dtype=np.uint64)
        for k in range(n):
            h = mix(h * U(3) + w[k : len(w) - n + 1 + k] + U(k + 1))
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if b - a >= n:
            yield np.unique(h[a : b - n + 1])
        elif b > a:
            one = np.full(1, b - a, dtype=np.uint64)
            for k in range(a, b):
                one = mix(one * U(5) + w[k : k + 1])
            yield one
        else:
            yield np.zeros(0, dtype=np.uint64)
