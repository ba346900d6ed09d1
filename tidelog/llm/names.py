"""Names of strings: 64-bit fingerprints that any sub-string gets from running sums, all in numpy.

A value in 2^64 arithmetic is given to every byte (or word), multiplied by a power of an odd base and summed up, so
the name of [a, b) is a difference of two sums times an inverse power. Equal strings have equal names wherever they
stand. A second, independent family is added where a decision rests on them. Such sums are equal for some pairs of long
and regular strings (Thue-Morse words and their mirrors), whatever the base, so strings longer than LONG are named by a
hash of their own bytes instead.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
#: Sums are taken over at most this many values, apart from single longer strings; and PIECE beginnings at once.
_USUAL = 1 << 20
PIECE = _USUAL - (1 << 13)
#: Bytes (or words) of a string up to which sums name it.
LONG = 256
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits; one to one."""
    x = x ^ (x >> np.uint64(31))
    x = x * _MIX
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _series(family: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASES[family], pow(_BASES[family], -1, 1 << 64)):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


@lru_cache(maxsize=2)
def _usual(family: int) -> tuple[np.ndarray, np.ndarray]:
    return _series(family, _USUAL)


def powers(family: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    p, q = _usual(family) if size <= _USUAL else _series(family, size)
    return p[:size], q[:size]


@lru_cache(maxsize=2)
def byte_values(family: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASES[1 - family])) | np.uint64(1)


class Sums:
    """Running sums over `values` (uint64), from which `name` takes any [a, b)."""

    def __init__(self, values: np.ndarray, family: int = 0):
        n = len(values)
        p, self._inverse = powers(family, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * p[:n], out=self.sums[1:])

    def name(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self._inverse[a]

    def every(self, length: int) -> np.ndarray:
        """The names of all sub-strings of this length, by start."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[length:] - self.sums[:n]) * self._inverse[:n]


def bytes_sums(data: np.ndarray, family: int = 0) -> Sums:
    return Sums(byte_values(family)[data], family)


def names_between(values: np.ndarray, a: np.ndarray, b: np.ndarray, family: int = 0) -> np.ndarray:
    """Names of [a, b), in bytes or words, with sums over a piece of the values at a time."""
    long = b - a > LONG
    if long.any():
        out = np.empty(len(a), np.uint64)
        out[~long] = names_between(values, a[~long], b[~long], family)
        values = np.ascontiguousarray(values)
        own = (xxhash.xxh64_intdigest(values[x:y], _BASES[family]) for x, y in zip(a[long].tolist(), b[long].tolist(), strict=True))
        out[long] = np.fromiter(own, np.uint64, int(long.sum()))
        return out
    if len(a) > 1 and (a[1:] < a[:-1]).any():
        order = np.argsort(a, kind="stable")
        out = np.empty(len(a), np.uint64)
        out[order] = names_between(values, a[order], b[order], family)
        return out
    out = np.empty(len(a), np.uint64)
    i = 0
    while i < len(a):
        lo = int(a[i])
        j = max(i + 1, int(np.searchsorted(a, lo + PIECE)))
        part = values[lo : int(b[i:j].max())]
        out[i:j] = (bytes_sums(part, family) if part.dtype == np.uint8 else Sums(part, family)).name(a[i:j] - lo, b[i:j] - lo)
        i = j
    return mix(out)


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours, by first of them, in log(width) passes."""
    if len(keys) < width:
        return keys[:0]
    out, have = keys, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def least_positions(names: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Where the least of every `width` names stands (the first of equals); depends on nothing but those names."""
    order = mix(names ^ np.uint64(salt)) & np.uint64(0xFFFFFFFF00000000)
    order |= np.arange(len(names), dtype=np.uint64)
    return (sliding_least(order, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def words_of(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in `data`; a word also ends before each of `starts` (beginnings of documents)."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = ~space
    first[1:] &= space[:-1]
    inner = starts[(starts > 0) & (starts < len(data))]
    first[inner] = ~space[inner]
    last = ~space
    last[:-1] &= space[1:]
    last[inner - 1] = ~space[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def equal_runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted keys."""
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.flatnonzero(new)
