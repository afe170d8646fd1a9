"""Vectorised tokenising and 64-bit hashing of UTF-8 bytes with numpy.

A word's hash is a polynomial over per-byte random constants, finished by a mixing
step; a word sequence's hash chains the word hashes.  Equal input gives equal
hashes on every executor (fixed constants)."""

from __future__ import annotations

import numpy as np

_MULT = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_CHUNK = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Finish 64-bit values so that every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence whose prefix hashes to ``left``, extended by ``right``."""
    return mix(left * _MULT + right)


class Words:
    """Which bytes separate words, and the constant of each byte (A-Z count as a-z)."""

    def __init__(self, separators: bytes):
        self.separator = np.zeros(256, bool)
        self.separator[list(separators)] = True
        const = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)
        const[65:91] = const[97:123]
        const[self.separator] = 0
        self.const = const
        self._powers = np.ones(1, np.uint64)

    def spans(self, raw: np.ndarray, offsets: np.ndarray):
        """(start, end, document) of every word, in order; documents end words."""
        if not len(raw):
            empty = np.zeros(0, np.int64)
            return empty, empty, empty
        sep = self.separator[raw]
        word = ~sep
        first, last = word.copy(), word.copy()
        first[1:] &= sep[:-1]
        last[:-1] &= sep[1:]
        begins = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[begins] = word[begins]
        ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        last[ends] = word[ends]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        return start, end, np.searchsorted(offsets, start, side="right") - 1

    def powers(self, n: int) -> np.ndarray:
        if len(self._powers) < n:
            grown = np.full(max(n, 2 * len(self._powers)), _STEP, np.uint64)
            grown[0] = 1
            self._powers = np.multiply.accumulate(grown)
        return self._powers

    def hashes(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of each word; about a megabyte of text at a time."""
        out = np.empty(len(start), np.uint64)
        i = 0
        while i < len(start):
            j = max(i + 1, int(np.searchsorted(start, start[i] + _CHUNK)))
            s, e = start[i:j], end[i:j]
            part = self.const[raw[s[0] : e[-1]]]
            place = np.arange(len(part), dtype=np.int64)
            place -= np.repeat(s - s[0], np.diff(np.append(s, e[-1])))
            part *= self.powers(int(place.max()) + 1)[place]
            out[i:j] = np.add.reduceat(part, s - s[0]) + (e - s).astype(np.uint64)
            i = j
        return mix(out)


#: Words separated by white space only.
PLAIN = Words(b" \t\n\x0b\x0c\r")
#: Words of letters, digits and non-ASCII characters; ASCII punctuation separates too.
LOOSE = Words(bytes(b for b in range(128) if not chr(b).isalnum()))
