"""Word and n-gram kernels over Arrow string columns, vectorised in numpy on UTF-8 bytes.

Two rules cut words, both after lower-casing A-Z only:

* ``SPACED``: runs of bytes other than space and ``\\x09-\\x0D``;
* ``ALNUM``: runs of digits, ASCII letters and non-ASCII characters.

Both separators are single ASCII bytes, so cutting UTF-8 bytes is the same as cutting characters.
Words and n-grams are named by 64-bit hashes; equal text gives equal hashes on every executor.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Modulus and base of the polynomial hash of byte spans. A prime modulus: modulo 2**64 some texts collide for any base.
_M = U64((1 << 61) - 1)
_B = 0x0F3C6EF372FE94F8 % ((1 << 61) - 1)
#: Bytes of text worked on at once (a longer document is worked on alone): bounds a worker's memory.
CHUNK_BYTES = 1 << 17

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Values of bytes in a hash, as they are and with A-Z in lower case.
_VALUE = np.arange(1, 257, dtype=np.uint64)
_LOWER_VALUE = _VALUE[_LOWER]
_SPACED = np.ones(256, dtype=bool)
_SPACED[[0x20, *range(0x09, 0x0E)]] = False
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SPACED, ALNUM = "spaced", "alnum"


def _tables() -> dict:
    """The worker process's own tables (functions travel by value, so a module's globals last for a task only)."""
    return sys.__dict__.setdefault("_kinweave_tables", {})


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values, so that any bits of a hash can be used."""
    with np.errstate(over="ignore"):
        x = x + U64((0xD1B54A32D192ED03 * (salt + 1)) % (1 << 64))
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    """64-bit numbers modulo 2**61 - 1."""
    x = (x & _M) + (x >> U64(61))
    return np.minimum(x, x - _M)  # below the modulus, the difference wraps to more


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2**61 - 1, from halves of 31 bits; 2**62 counts as 2 and 2**61 as 1."""
    low, high = U64((1 << 31) - 1), U64(31)
    a0, a1, b0, b1 = a & low, a >> high, b & low, b >> high
    mid = a1 * b0 + a0 * b1
    return _reduced(U64(2) * a1 * b1 + (mid >> U64(30)) + ((mid & U64((1 << 30) - 1)) << high) + a0 * b0)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=U64)
    while len(out) < n:
        out = np.concatenate([out, _times(out, np.full(1, pow(base, len(out), int(_M)), dtype=U64))])
    return out[:n]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; tables longer than a chunk's are not kept."""
    tables = _tables()
    kept = CHUNK_BYTES + 1
    if n > kept:
        return _powers(_B, n), _powers(pow(_B, -1, int(_M)), n)
    if "up" not in tables:
        tables["up"], tables["down"] = _powers(_B, kept), _powers(pow(_B, -1, int(_M)), kept)
    return tables["up"], tables["down"]


class Sums:
    """Prefix sums of byte values times powers of the base, in two parts that cannot overflow."""

    __slots__ = ("low", "high", "down")
    #: Values whose sum cannot reach the modulus: within so many, sums are differences as they stand.
    BLOCK = 1 << 20

    def __init__(self, data: np.ndarray, values: np.ndarray = _VALUE):
        up, self.down = _power(len(data) + 1)
        self._set(values[data], up[: len(data)])

    def _set(self, value: np.ndarray, up: np.ndarray) -> None:
        self.low, self.high = self._sums(value * (up & U64((1 << 31) - 1))), self._sums(value * (up >> U64(31)))

    @classmethod
    def _sums(cls, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x) + 1, dtype=U64)
        out[0] = 0
        for lo in range(0, len(x), cls.BLOCK):
            hi = min(lo + cls.BLOCK, len(x))
            own = out[lo + 1 : hi + 1]
            np.cumsum(x[lo:hi], out=own)
            if lo:
                own += out[lo] % _M
        return out

    def __len__(self) -> int:
        return len(self.low)

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash, before mixing, of the spans [start, end)."""

        def part(x: np.ndarray) -> np.ndarray:
            if len(x) <= self.BLOCK + 1:
                return x[end] - x[start]
            return _reduced(_reduced(x[end]) + _M - _reduced(x[start]))

        high = part(self.high)
        whole = part(self.low) + (((high << U64(31)) & _M) | (high >> U64(30)))
        return _times(_reduced(whole), self.down[start])


class WordSums(Sums):
    """Prefix sums of word hashes times powers of the base: spans are of words."""

    def __init__(self, words: np.ndarray):
        up, self.down = _power(len(words) + 1)
        value = _times(_reduced(words), up[: len(words)])
        self.low, self.high = (self._sums(part) for part in (value & U64((1 << 31) - 1), value >> U64(31)))


def prefix_sums(data: np.ndarray, values: np.ndarray = _VALUE) -> Sums:
    return Sums(data, values)


def span_hash(sums: Sums, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
    """Position-independent hashes of the byte spans [start, end)."""
    with np.errstate(over="ignore"):
        return mix(sums.between(start, end) + (end - start).astype(U64) * U64(0x9E3779B97F4A7C15), salt)


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return _LOWER[data]


class Words:
    """The words of some documents: ``hash``, byte ``start`` and ``end``, and ``first[i]:first[i+1]`` the words of document i."""

    __slots__ = ("data", "offsets", "hash", "start", "end", "first")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rule: str):
        self.data, self.offsets = data, offsets
        inside = (_SPACED if rule == SPACED else _ALNUM)[data]
        n = len(data)
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.zeros(n, dtype=bool)
        before[1:] = inside[:-1]
        after = np.zeros(n, dtype=bool)
        after[:-1] = inside[1:]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.hash = span_hash(prefix_sums(data, _LOWER_VALUE), self.start, self.end)
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.first) - 1


def grams(words: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hashes of the n-grams of consecutive words; entry i is of words[i:i+n]."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=U64)
    out = np.zeros(m, dtype=U64)
    factors = mix(np.arange(n, dtype=U64), 900) | U64(1)  # unrelated ones: powers of one number let some sequences collide
    with np.errstate(over="ignore"):
        for j in range(n):
            out += words[j : j + m] * factors[j]
    return mix(out, 1000 * n + salt)


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column without copying; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offs, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``most`` bytes, or of one document."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_chunks(column: pa.Array, rule: str, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, last row, words) for bounded pieces of an Arrow column."""
    data, offsets = binary_parts(column)
    for lo, hi in chunks(offsets, most):
        yield lo, hi, Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], rule)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return x.view(np.int64)
