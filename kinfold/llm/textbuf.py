"""Flat byte buffers for Arrow text columns, word keys, and fingerprints of slices.

Every text operator of this subpackage works on whole Arrow batches: the
column's value buffer is one ``uint8`` array and each document is a slice of it.

``Words`` names slices of up to seven bytes by their own bytes, so these can't
collide, and longer ones by a chain of mixed numbers.  ``PrefixHash`` names arbitrary slices of one block from prefix sums,

    P[i] = sum_{k<i} T[b_k] * B^k,   h(i, j) = (P[j] - P[i]) * B^-i

with a table ``T`` of random numbers and a base ``B``: keys modulo 2^64, and checks
of their own table and base modulo the prime 2^31 - 1.  An identity needs both: there
are strings that collide modulo 2^64 for every base, but not modulo a prime.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import xxhash

SEED = 20240229
_rng = np.random.default_rng(SEED)
#: Numbers of bytes for the order of windows, modulo 2^64.
BYTE_WORDS = _rng.integers(0, 2**64, 256, dtype=np.uint64)
BASE = int(_rng.integers(0, 2**62)) * 4 + 1
_INV = pow(BASE, -1, 2**64)
PRIME = (1 << 31) - 1
_P, _31 = np.uint64(PRIME), np.uint64(31)
CHECK_WORDS = _rng.integers(1, PRIME, 256, dtype=np.uint64)
CHECK_BASE = int(_rng.integers(1 << 20, PRIME - 1))
_CHECK_INV = pow(CHECK_BASE, -1, PRIME)

PART = 1 << 14  # numbers at a time that stay in a core's cache

_TABLES: dict[str, np.ndarray] = {}


def _grown(name: str, n: int, make) -> np.ndarray:
    """The table of a name with n entries or more, kept per process."""
    if name not in _TABLES or len(_TABLES[name]) < n:
        _TABLES[name] = make(max(n, 1 << 16))
    return _TABLES[name]


def _powers_wrapped(base: int):
    def make(n):
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out, out=out)

    return make


def _powers_prime(base: int):
    def make(n):
        out = np.ones(1, dtype=np.uint64)
        while len(out) < n:  # doubling
            out = np.concatenate([out, out * np.uint64(pow(base, len(out), PRIME)) % _P])
        return out[:n].astype(np.uint32)

    return make


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (multiply-xorshift, two rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class PrefixHash:
    """Keys and checks of slices of one byte block; give it blocks of bounded size."""

    def __init__(self, buf: np.ndarray):
        self.buf = buf
        n = len(buf)
        self.inverse = _grown("i", n + 1, _powers_wrapped(_INV))
        powers = _grown("w", n + 1, _powers_wrapped(BASE))
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        for lo in range(0, n, PART):
            term = BYTE_WORDS[buf[lo : lo + PART]]
            term *= powers[lo : lo + len(term)]
            term[:1] += self.prefix[lo : lo + 1]
            np.cumsum(term, out=self.prefix[lo + 1 : lo + 1 + len(term)])
        self._sums: np.ndarray | None = None

    def every(self, size: int) -> np.ndarray:
        """Keys of all slices of ``size`` bytes."""
        n = len(self.prefix) - size
        out = self.prefix[size:] - self.prefix[:n]
        out *= self.inverse[:n]
        return out

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.inverse[start]

    def checks(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """31 bits of each slice, modulo the prime."""
        n = len(self.buf)
        if self._sums is None and len(start):
            powers = _grown("p", n + 1, _powers_prime(CHECK_BASE))
            self._sums = np.zeros(n + 1, dtype=np.uint64)
            for lo in range(0, n, PART):
                term = CHECK_WORDS[self.buf[lo : lo + PART]]
                term *= powers[lo : lo + len(term)]
                more = term >> _31
                term &= _P
                term += more  # below 2^32, so sums of 2^32 of them fit
                term[:1] += self._sums[lo : lo + 1]
                np.cumsum(term, out=self._sums[lo + 1 : lo + 1 + len(term)])
        if not len(start):
            return np.zeros(0, np.int32)
        x = (self._sums[end] - self._sums[start]) % _P
        x *= _grown("q", n + 1, _powers_prime(_CHECK_INV))[start]
        return (x % _P).astype(np.int32)


_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
SHORT, MEDIUM = 7, 256


class Words:
    """Slices of one block as numbers, eight bytes at a time."""

    def __init__(self, buf: np.ndarray, padded: bool = False):
        self.raw = buf if padded else np.concatenate([buf, np.zeros(8, np.uint8)])
        self.view = np.ndarray((len(self.raw) - 7,), "<u8", self.raw, strides=(1,))

    def head(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The first bytes of slices, eight at most."""
        return self.view[start] & _MASK[np.minimum(size, 8)]

    def exact(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Slices of up to seven bytes as their bytes and their number; others in part."""
        return self.view[start] & _MASK[np.minimum(size, SHORT)] | np.minimum(size, 255).astype(np.uint64) << np.uint64(56)

    def keys(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit keys: one to one up to seven bytes; eight bytes at a time, mixed each, up to 256; xxh3 beyond."""
        size = end - start
        out = mix64(self.exact(start, size))
        live = np.flatnonzero((size > SHORT) & (size <= MEDIUM))
        if len(live):
            h = size[live].astype(np.uint64) * _ODD
            at, left = start[live], size[live]
            while len(live):
                h = mix64(h * _ODD + self.head(at, left))
                done = left <= 8
                out[live[done]] = h[done]
                live, h, at, left = live[~done], h[~done], at[~done] + 8, left[~done] - 8
        for i in np.flatnonzero(size > MEDIUM).tolist():
            out[i] = xxhash.xxh3_64_intdigest(self.raw[start[i] : end[i]])
        return out


def same_bytes(x: Words, x_start: np.ndarray, y: Words, y_start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether slices of equal size hold the same bytes, eight at a time."""
    out = np.ones(len(size), bool)
    live = np.flatnonzero(size <= MEDIUM)
    a, b, left = x_start[live], y_start[live], size[live]
    while len(live):
        equal = x.head(a, left) == y.head(b, left)
        out[live[~equal]] = False
        go = equal & (left > 8)
        live, a, b, left = live[go], a[go] + 8, b[go] + 8, left[go] - 8
    for i in np.flatnonzero(size > MEDIUM).tolist():
        out[i] = np.array_equal(x.raw[x_start[i] : x_start[i] + size[i]], y.raw[y_start[i] : y_start[i] + size[i]])
    return out


def text_keys(buf: np.ndarray, offsets: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit keys of whole documents by xxh3."""
    raw, off = memoryview(buf), offsets.tolist()
    return np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b], seed) for a, b in zip(off[:-1], off[1:])), np.uint64, len(off) - 1)


try:
    _libc = ctypes.CDLL(None)
    # keep freed arrays of a block for the next one: fetching new pages costs more than the work on them
    _libc.mallopt(-1, 32 << 20)  # M_TRIM_THRESHOLD
    _libc.mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD
except (OSError, AttributeError):  # not this C library
    _libc = None


#: How to drop what a worker keeps between tasks, by the name of what it is for.
_KEPT: dict = {}


def keep(name: str, drop) -> None:
    """Have ``drop`` called once a task of another purpose ends in this worker."""
    _KEPT[name] = drop


def give_back(but: str = "") -> None:
    """Return memory that this worker no longer uses, what is kept for other purposes too; idle workers stay beside the busy ones."""
    for name in [k for k in _KEPT if k != but]:
        _KEPT.pop(name)()
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def text_column(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.binary())
    if pa.types.is_null(col.type):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), off - off[0]
    buf = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]]
    return buf, off - off[0]


def blocks(offsets: np.ndarray, limit: int):
    """Consecutive document ranges [lo, hi) of at most ``limit`` bytes each (or one document)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def expand(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenated ranges start[i] .. start[i]+length[i]."""
    total = int(length.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(length)
    out = np.arange(total, dtype=np.int64)
    out += np.repeat(start.astype(np.int64) - (ends - length), length)
    return out
