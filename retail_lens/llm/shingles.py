"""Word shingles of whole texts as sets of 64-bit hashes, by array arithmetic over the bytes."""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240501))
_OF_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_OF_BYTE = _OF_BYTE[_LOWER]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_CHUNK = 1 << 20
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverses
    while len(_powers) < n:
        k = np.uint64(len(_powers))
        _powers = np.concatenate([_powers, _powers * _pow(_BASE, int(k))])
        _inverses = np.concatenate([_inverses, _inverses * _pow(_INVERSE, int(k))])


def _pow(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 2**64))


def mixed(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashes(raw: np.ndarray) -> np.ndarray:
    """A hash per word: sum of its letters' values times the powers of a base by position."""
    blank = np.empty(len(raw) + 2, bool)
    blank[0] = blank[-1] = True
    blank[1:-1] = _BLANK[raw]
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    begin, end = edge[0::2], edge[1::2]
    if not len(begin):
        return np.empty(0, np.uint64)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_OF_BYTE[raw] * _powers[: len(raw)], out=sums[1:])
    return mixed((sums[end] - sums[begin]) * _inverses[begin] + (end - begin).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text in order, letters A-Z as a-z. Long texts go through in chunks of whole words."""
    raw = np.frombuffer(text, np.uint8)
    parts, at = [], 0
    while at < len(raw):
        to = min(at + _CHUNK, len(raw))
        while to < len(raw) and not _BLANK[raw[to]]:
            to += 1
        _grow(to - at)
        with np.errstate(over="ignore"):
            parts.append(_hashes(raw[at:to]))
        at = to
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words; of the whole sequence if it is shorter; empty without words."""
    words = word_hashes(text)
    if not len(words):
        return words
    n = min(width, len(words))
    with np.errstate(over="ignore"):
        total = np.full(len(words) - n + 1, n, np.uint64)
        for i in range(n):
            total = mixed(total + words[i : len(words) - n + 1 + i]) * np.uint64(2 * i + 3)
        return np.unique(mixed(total))
