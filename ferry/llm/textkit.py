"""Vectorised text primitives shared by the Arrow-side operators.

Texts of an Arrow batch are handled as one byte buffer with document offsets, cut
into chunks of about half a MB (a longer text is a chunk of its own, never cut).
Words, hashes of words and of word or byte ranges are then numpy array
operations; no Python code runs per word. Hashes are 64 bit: random byte values,
a polynomial in an odd base modulo 2**64, and a finalising mix.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK_BYTES = 1 << 19


def give_back() -> None:
    """Hands freed memory back to the system: Spark reuses Python workers, which else keep the peak of all earlier tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def frugal(run):
    """An Arrow map function that gives its memory back at the end of its task."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return task


def _mixed(x: int) -> int:
    m = (1 << 64) - 1
    x = (x + 0x9E3779B97F4A7C15) & m
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & m
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m
    return x ^ (x >> 31)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (a bijection)."""
    x = x + U(0x9E3779B97F4A7C15)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE_VALUES = np.array([_mixed(b + 1000) for b in range(256)], dtype=U)
BASE = _mixed(7) | 1
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse modulo 2**64; cache belongs to the task."""
    have = cache.get("powers")
    if have is None or len(have[0]) < n:
        n = max(n, CHUNK_BYTES + 1024)
        inverse = pow(BASE, -1, 1 << 64)
        both = []
        for b in (BASE, inverse):
            p = np.full(n, b, dtype=U)
            p[0] = 1
            both.append(np.cumprod(p, dtype=U))
        cache["powers"] = have = tuple(both)
    return have


class Ranges:
    """Hashes of any range of a value sequence, by prefix sums."""

    def __init__(self, values: np.ndarray, cache: dict):
        p, self.inverse = powers(len(values) + 1, cache)
        self.sums = np.zeros(len(values) + 1, dtype=U)
        np.cumsum(values * p[: len(values)], out=self.sums[1:])

    def at(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.sums[hi] - self.sums[lo]) * self.inverse[lo])


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES):
    """(first row, end row, uint8 buffer, int64 offsets from 0) of consecutive rows; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    binary = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(binary.buffers()[1], dtype=np.int64)[binary.offset: binary.offset + len(binary) + 1]
    data = np.frombuffer(binary.buffers()[2], dtype=np.uint8) if binary.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(binary):
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(binary))
        yield lo, hi, data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        lo = hi


class Words:
    """The words (runs of bytes other than space and 0x09-0x0D) of a chunk, in order.

    start, end: byte positions; doc: row in the chunk; hash: 64 bit;
    first: index of each row's first word, with one more entry at the end.
    """

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, cache: dict):
        n = len(buf)
        inside = np.ones(n + 1, dtype=bool)
        inside[:n] = ~SPACE[buf]
        inside[n] = False
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        edge = offsets[:-1][offsets[:-1] < n]
        opens[edge] |= inside[edge]
        self.start = np.flatnonzero(opens)
        closes = inside[:n] & (~inside[1:] | False)
        last = offsets[1:][offsets[1:] > 0] - 1
        closes[last] |= inside[last]
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)
        self.hash = Ranges(BYTE_VALUES[buf], cache).at(self.start, self.end)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each width consecutive values (len(v) - width + 1 of them; none if v is shorter)."""
    if len(v) < width:
        return v[:0]
    done, out = 1, v
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def long_array(x: np.ndarray) -> pa.Array:
    """64-bit values as a signed Arrow column, bits unchanged."""
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == U else x.astype(np.int64))


def join_intervals(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as disjoint, sorted, maximal ones (touching ones become one)."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), dtype=bool)
    new[1:] = lo[1:] > hi[:-1]
    ends = np.append(np.flatnonzero(new)[1:] - 1, len(lo) - 1)
    return lo[new], hi[ends]
