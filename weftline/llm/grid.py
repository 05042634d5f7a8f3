"""Hashes of all words of a batch of texts at once, by numpy.

A word's hash is a polynomial in its bytes, taken from prefix sums over the whole batch and mixed, so there is no loop over
words. Words are separated by space and U+0009 to U+000D; A-Z are lower-cased.
"""

from __future__ import annotations

import numpy as np

_rng = np.random.Generator(np.random.PCG64(7))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        out = np.ones(size, dtype=np.uint64)
        done = 1
        while done < size:
            out[done : 2 * done] = out[:done] * np.uint64(pow(base, done, 1 << 64))
            done *= 2
        _powers[base] = have = out
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed polynomial hashes of values[starts:ends]; values: 64-bit codes of the characters."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * powers(_BASE, n), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the index of its text."""
    data = b"\n".join(texts).lower()
    codes = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(codes) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[codes]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.zeros(len(texts), dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts[:-1]], out=first[1:])
    return spans(_BYTE[codes], starts, ends), np.searchsorted(first, starts, side="right") - 1


def slices(texts: list[bytes], size: int = 1 << 20):
    """(index of the first, texts) of runs of about so many bytes."""
    part, held, at = [], 0, 0
    for k, t in enumerate(texts):
        part.append(t)
        held += len(t)
        if held >= size:
            yield at, part
            part, held, at = [], 0, k + 1
    if part:
        yield at, part
