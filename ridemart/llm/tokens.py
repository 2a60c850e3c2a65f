"""Vectorised text access inside Arrow tasks: byte buffers, word spans and 64-bit hashes.

All functions work on one slice of a batch, whose size is bounded in bytes
(a single longer text forms a slice of its own), so a task's memory follows
the slice and the longest text, not the partition. Hashes are polynomial
prefix hashes over bytes, finished with a bit mixer; equal spans always have
equal hashes.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_libc = ctypes.CDLL(None) if hasattr(ctypes.CDLL(None), "malloc_trim") else None
_M = 0x9E3779B97F4A7C15 | 1
_INV = pow(_M, -1, 2**64)
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """M^i and M^-i for i < n (kept between calls, grown on demand)."""
    global _pow, _inv
    if len(_pow) < n:
        n = max(n, SLICE_BYTES + 64)
        p = np.full(n, np.uint64(_M))
        q = np.full(n, np.uint64(_INV))
        p[0] = q[0] = 1
        _pow, _inv = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _pow, _inv


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


def byte_class(*ranges: tuple[int, int], invert: bool = False) -> np.ndarray:
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a:b + 1] = True
    return ~t if invert else t


#: Words of [^\x20\x09-\x0D]+ .
BLANK_WORDS = byte_class((0x20, 0x20), (0x09, 0x0D), invert=True)
#: Words of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing A-Z).
ALNUM_WORDS = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F), invert=True)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Texts:
    """Some consecutive texts of a batch as one byte buffer; null counts as empty."""

    def __init__(self, arr: pa.Array, binary: bool = False):
        arr = arr.cast(pa.large_binary() if binary else pa.large_string())
        if arr.null_count:
            arr = arr.fill_null("")
        _, offs, data = arr.buffers()
        off = np.frombuffer(offs, np.int64)[arr.offset:arr.offset + len(arr) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.data = raw[off[0]:off[-1]]
        self.off = off - off[0]
        self.n = len(arr)


def trim() -> None:
    """Give freed memory back to the system: idle workers would hold on to it otherwise."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def slices(arr: pa.Array, max_bytes: int = SLICE_BYTES):
    """(first row, Texts) pieces of at most ``max_bytes`` each, one text at least."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string())
    lens = np.asarray(pc.fill_null(pc.binary_length(arr), 0))
    ends = np.cumsum(lens)
    i, n = 0, len(arr)
    while i < n:
        base = ends[i - 1] if i else 0
        j = max(int(np.searchsorted(ends, base + max_bytes, "right")), i + 1)
        yield i, Texts(arr.slice(i, j - i))
        i = j
    trim()


class Words:
    """Word spans of a slice: byte start/end, document index and word hash of every word."""

    def __init__(self, t: Texts, is_word: np.ndarray, lower: bool = False, hashes: bool = True):
        data = LOWER[t.data] if lower else t.data
        n = len(data)
        w = is_word[data]
        first = np.zeros(n + 1, bool)
        first[t.off[:-1]] = True
        first[n] = True
        st = w.copy()
        st[1:] &= ~(w[:-1] & ~first[1:n])
        en = w.copy()
        en[:-1] &= ~(w[1:] & ~first[1:n])
        self.start = np.flatnonzero(st)
        self.end = np.flatnonzero(en) + 1
        self.data = data
        self.first = np.searchsorted(self.start, t.off)          # word range of text d: first[d]..first[d+1]
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(t.n), self.count)
        if hashes:
            self.hash_of = SpanHash(data)
            self.hash = self.hash_of(self.start, self.end)

    def __len__(self):
        return len(self.start)


class SpanHash:
    """Hash of any byte span of a buffer from one prefix pass."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.p, self.q = _powers(n + 1)
        x = data.astype(np.uint64)
        x += np.uint64(1)
        x *= self.p[:n]
        self.pre = np.zeros(n + 1, np.uint64)
        np.cumsum(x, out=self.pre[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.pre[end] - self.pre[start]) * self.q[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def fixed(self, k: int) -> np.ndarray:
        """Hash of the k bytes from every position (empty if the buffer is shorter)."""
        n = len(self.pre) - 1
        if n < k:
            return np.zeros(0, np.uint64)
        h = (self.pre[k:] - self.pre[:n - k + 1]) * self.q[:n - k + 1]
        return mix(h + np.uint64(k * 0xD6E8FEB86659FD93 & (2**64 - 1)))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive item hashes, by start position (length n-k+1)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc *= np.uint64(_M)
        acc += h[j:j + n]
    return mix(acc + np.uint64(k))


def grams_at(h: np.ndarray, k: int, at: np.ndarray) -> np.ndarray:
    """The same hash, only for the given start positions."""
    acc = np.zeros(len(at), np.uint64)
    for j in range(k):
        acc *= np.uint64(_M)
        acc += h[at + j]
    return mix(acc + np.uint64(k))


def whole_starts(count: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Start positions of k-item windows that stay inside one text."""
    m = np.maximum(count - k + 1, 0)
    total = int(m.sum())
    if not total:
        return np.zeros(0, np.int64)
    base = np.repeat(first[:len(count)] - (np.cumsum(m) - m), m)
    return base + np.arange(total)


_POS = np.uint64(0xFFFFFFFF)


def sliding_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost smallest value in every window of w values (by the upper 32 bits)."""
    n = len(h)
    if n < w:
        return np.zeros(0, np.int64)
    m = (h & ~_POS) | np.arange(n, dtype=np.uint64)
    span = 1
    while span * 2 <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if span < w:
        m = np.minimum(m[:len(m) - (w - span)], m[w - span:])
    return (m & _POS).astype(np.int64)


def covered(starts: np.ndarray, lengths, size: int) -> np.ndarray:
    """Boolean cover of [start, start+length) spans over ``size`` positions."""
    d = np.zeros(size + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + lengths, -1)
    return np.cumsum(d[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of True."""
    d = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """list<kind> column from concatenated values and the number of them in each row."""
    off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, kind))


class Units:
    """Texts cut before every run of spaces (and around line feeds): pieces that never share a token.

    Every text is first given one leading space. ``index`` numbers the units
    of the slice by distinct content; ``first`` gives each text's unit range.
    """

    def __init__(self, t: Texts, salt: np.ndarray | None = None):
        n, m = len(t.data), t.n
        doc = np.repeat(np.arange(m), np.diff(t.off))
        buf = np.full(n + m, 0x20, np.uint8)
        buf[np.arange(n) + doc + 1] = t.data
        off = t.off + np.arange(m + 1)
        cut = np.zeros(n + m + 1, bool)
        space = buf == 0x20
        cut[:-1] = space
        cut[1:-1] &= ~space[:-1]
        feed = np.flatnonzero(buf == 0x0A)
        cut[feed] = cut[feed + 1] = True
        cut[off] = True
        edge = np.flatnonzero(cut)
        self.buf, self.start, self.end = buf, edge[:-1], edge[1:]
        self.first = np.searchsorted(self.start, off)
        self.first[-1] = len(self.start)
        h = SpanHash(buf)(self.start, self.end)
        if salt is not None:                # texts with another salt get other units
            h = mix(h ^ np.repeat(salt, np.diff(self.first)))
        self.key, at, self.index = np.unique(h, return_index=True, return_inverse=True)
        self.example = at

    def content(self, i: int) -> bytes:
        a = self.example[i]
        return self.buf[self.start[a]:self.end[a]].tobytes()


def gather(values: np.ndarray, start: np.ndarray, length: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of the spans start[i], length[i] of ``values`` for i in index, and the length of each part."""
    size = length[index]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(start[index] - (ends - size), size)
    return values[at], size
