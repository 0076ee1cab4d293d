"""Words of whole Arrow batches with numpy: no Python loop over words.

A word's hash is a polynomial over its bytes modulo 2**64, taken from prefix sums and mixed
afterwards.  Two words with equal 64-bit hashes count as equal.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Texts are handled in pieces of about this many bytes (a longer text is one piece), so memory
#: does not follow the size of a batch.
PIECE = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: white space: \x20, \x09-\x0D
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: everything in ASCII but digits and letters (after lower-casing)
NONWORD = np.zeros(256, bool)
NONWORD[:128] = True
NONWORD[48:58] = False
NONWORD[97:123] = False

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE + 2), U(base), U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h ^= h >> U(29)
    h = h * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(32))


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past last row, bytes, offsets) of runs of rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and column.buffers()[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def split(b: np.ndarray, off: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each text the index of its first word (with one more at the end)."""
    w = ~sep[b]
    start, end = w.copy(), w.copy()
    if len(b):
        start[1:] &= ~w[:-1]
        end[:-1] &= ~w[1:]
        first = off[:-1][off[:-1] < len(b)]
        start[first] = w[first]
        last = off[1:] - 1
        last = last[last >= 0]
        end[last] = w[last]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(s, off)


def word_hashes(b: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of b[s:e]."""
    sums = np.zeros(len(b) + 1, U)
    np.cumsum((b.astype(U) + U(1)) * powers(BASE, len(b)), out=sums[1:])
    return mix((sums[e] - sums[s]) * powers(INVERSE, len(b) + 1)[s])


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k of h (none if there are fewer)."""
    if len(h) < k:
        return np.zeros(0, U)
    out = np.zeros(len(h) - k + 1, U)
    for i in range(k):
        out = (out * U(BASE)) ^ h[i : i + len(out)]
        out = mix(out) if i < k - 1 else out
    return mix(out + U(k))


def lean(run):
    """A function over batches that gives memory back to the system at the end of its task; workers are kept for later ones."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return wrapped


def long_array(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))
