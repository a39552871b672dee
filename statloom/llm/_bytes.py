"""Whole-column byte arithmetic on Arrow string columns.

A batch of texts is one flat uint8 array plus document offsets. Every helper
keeps documents apart by those offsets, so no word, line or window crosses
from one document to the next. Nulls have length zero.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 2**64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit integers (the finaliser of splitmix64)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_CODE = mix64(np.arange(1, 257, dtype=U64) * U64(_BASE))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept and regrown per worker."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        steps = np.full(size, base, U64)
        steps[0] = 1
        got = _powers[base] = np.multiply.accumulate(steps)
    return got[:n]


class Rolling:
    """Polynomial hashes of any span of a sequence of 64-bit codes, from one prefix sum."""

    def __init__(self, codes: np.ndarray):
        self.sums = np.empty(len(codes) + 1, U64)
        self.sums[0] = 0
        np.cumsum(codes * powers(_BASE, len(codes)), out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * powers(_INV, len(self.sums))[start] + (end - start).astype(U64))

    def windows(self, width: int) -> np.ndarray:
        """The hash of every window of this width, by its start."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, U64)
        return mix64((self.sums[width:] - self.sums[:n]) * powers(_INV, n))


def flat_text(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, is_null) of a string or binary Arrow array, without copying texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    null = np.asarray(col.is_null())
    n = len(col)
    _, off, data = col.buffers()
    if n == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64), null
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if null.any():  # a null slot may hide bytes: close the gaps
        size = np.where(null, 0, np.diff(offs))
        if size.sum() != offs[-1] - offs[0]:
            buf = np.concatenate([buf[a : a + s] for a, s in zip(offs[:-1], size, strict=True)]) if n else buf
            offs = np.concatenate([[0], np.cumsum(size)])
    return buf[offs[0] : offs[-1]], offs - offs[0], null


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # another C library
    _trim = None


def give_back() -> None:
    """Gives memory that is free to the system: workers live on between tasks, and what they hold in reserve with them."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def groups(off: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of about this many bytes; a longer document is its own run."""
    at, n = 0, len(off) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)
    give_back()


def per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many positions are set in each document."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[off[1:]] - sums[off[:-1]]


def word_spans(is_word: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each maximal run of word bytes inside one document."""
    n = len(is_word)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    first = np.zeros(n + 1, bool)
    first[off] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = is_word[:-1]
    start = np.flatnonzero(is_word & (~before | first[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = is_word[1:]
    end = np.flatnonzero(is_word & (~after | first[1:])) + 1
    doc = np.searchsorted(off, start, "right") - 1
    return start, end, doc


def table_of(test) -> np.ndarray:
    return np.array([bool(test(b)) for b in range(256)])


#: Bytes of `[^\x20\x09-\x0D]`.
VISIBLE = table_of(lambda b: b != 32 and not 9 <= b <= 13)
#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after lower-casing A-Z.
PLAIN = table_of(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
#: A-Z to a-z, every other byte as it is.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def lengths_cover(start: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n positions lie in [s, s + width) for any of these starts."""
    edge = np.zeros(n + width + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + width, -1)
    return np.cumsum(edge)[:n] > 0
