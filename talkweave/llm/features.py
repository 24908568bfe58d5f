"""Hashed character and word features of whole texts, vectorised with numpy."""

from __future__ import annotations

from functools import cache

import numpy as np

#: Odd multipliers of the n-gram hashes (32 bits).
_M = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)]
_ONE = np.uint64(1)


@cache
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def has_letter(text: str) -> bool:
    return bool(letters()[points(text)].any())


def only_letters(text: str) -> np.ndarray:
    """Code points in lower case, each stretch of anything but letters as one space."""
    cp = points(text.lower())
    if not len(cp):
        return np.array([32, 32], np.uint32)
    cp = np.where(letters()[cp], cp, np.uint32(32))
    cp = np.concatenate((np.array([32], np.uint32), cp, np.array([32], np.uint32)))
    return cp[np.concatenate(([True], (cp[1:] != 32) | (cp[:-1] != 32)))]


def char_grams(cp: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """The hashes of all n-grams of the sizes, in ``bits`` bits."""
    out = []
    for n in sizes:
        if len(cp) < n:
            continue
        h = np.full(len(cp) - n + 1, np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF), np.uint32)
        for k in range(n):
            h = (h ^ cp[k : len(cp) - n + 1 + k]) * _M[k]
            h ^= h >> np.uint32(15)
        out.append(h >> np.uint32(32 - bits))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def word_hashes(cp: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each run of code points over 32."""
    inside = np.concatenate(([False], cp > 32, [False]))
    starts = np.nonzero(inside[1:] & ~inside[:-1])[0]
    stops = np.nonzero(~inside[1:] & inside[:-1])[0]
    if not len(starts):
        return np.zeros(0, np.uint64)
    n, base = len(cp), np.uint64(0x9E3779B97F4A7C15)
    place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n))) if starts[0] == 0 else np.arange(n) - np.concatenate((np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(np.append(starts, n)))))
    powers = np.cumprod(np.concatenate((np.array([1], np.uint64), np.full(int((stops - starts).max()) - 1, base, np.uint64))))
    terms = np.where(inside[1:-1], (cp.astype(np.uint64) + _ONE) * powers[np.minimum(place, len(powers) - 1)], np.uint64(0))
    return np.add.reduceat(terms, starts)


def fold(h: np.ndarray, bits: int) -> np.ndarray:
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)).astype(np.int64)
