"""Vectorised text helpers for Arrow batches: byte views, word boundaries and
64-bit hashes of words and word shingles, without a Python loop over words.

Texts are processed whole, in slices of about ``SLICE_BYTES`` (a longer text
is a slice of its own), so the arrays of a worker stay small."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SHINGLE = 5

_U = np.uint64
_MULT = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection on 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    """A hash of ``x`` from the family numbered by ``seed``."""
    return mix(x + _U((seed * _MULT + 0x632BE59BD9B4E019) & _MASK))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as doubles in (0, 1]."""
    return ((x >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_MULT))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[:33] = True


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up, self.down


_POWERS = _Powers()


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, large_string array without nulls) pieces of about ``limit``
    bytes; a null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    total = np.concatenate([[0], np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))])
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(total, total[a] + limit, "right")) - 1)
        yield a, column.slice(a, b - a)
        a = b


def view(texts: pa.Array, end: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each followed by ``end``, and the n + 1 offsets."""
    joined = pc.binary_join_element_wise(texts.cast(pa.large_binary()), pa.scalar(end, pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    if isinstance(joined, pa.ChunkedArray):
        joined = joined.combine_chunks()
    _, off, data = joined.buffers()
    offsets = np.frombuffer(off, np.int64)[joined.offset : joined.offset + len(joined) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def lowered(raw: np.ndarray) -> np.ndarray:
    """ASCII letters in lower case."""
    return _LOWER[raw]


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True; the last item is False."""
    step = np.diff(inside.view(np.int8), prepend=np.int8(0))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


class Prefix:
    """Prefix sums for polynomial hashes: a hash of any byte range in O(1)."""

    def __init__(self, raw: np.ndarray) -> None:
        up, self.down = _POWERS.get(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * up[: len(raw)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of bytes over 0x20, ASCII letters lowered) of all texts:
    hashes, first and end bytes in their own text, and n + 1 offsets of the
    texts in the word list."""
    raw, offsets = view(texts)
    low = lowered(raw)
    start, end = runs(~_SPACE[low])
    first = np.searchsorted(start, offsets)
    hashes = Prefix(low).hash(start, end) if len(start) else np.zeros(0, np.uint64)
    base = np.repeat(offsets[:-1], np.diff(first))
    return hashes, start - base, end - base, first


def shingles(hashes: np.ndarray, first: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, text by text, and n + 1 offsets.
    A text of 1 to size - 1 words has one shingle, of all its words."""
    n = np.diff(first)
    counts = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    out_first = np.concatenate([[0], np.cumsum(counts)])
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    at = np.arange(out_first[-1]) - np.repeat(out_first[:-1], counts) + np.repeat(first[:-1], counts)
    left = np.repeat(first[1:], counts) - at
    out = np.zeros(len(at), np.uint64)
    for j in range(size):
        part = seeded(padded[at + j], 101 + j)
        part[left <= j] = 0
        out += part
    return mix(out), out_first


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets (0 for empty ones)."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), values.dtype)
    np.cumsum(values, axis=0, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array from flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
