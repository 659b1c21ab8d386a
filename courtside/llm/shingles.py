"""Word shingles of texts as 64-bit fingerprints, for many texts at a time."""

from __future__ import annotations

import hashlib

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: Bytes between words: space, tab, line feed, vertical tab, form feed, carriage return.
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def powers(base: int, count: int) -> np.ndarray:
    """``base`` to the power 0, 1, ... modulo 2^64."""
    out = np.full(max(1, count), np.uint64(base))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Powers:
    """Powers of an odd base and of its inverse, grown as longer buffers come."""

    def __init__(self, base: int = _BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            size = 1 << (count - 1).bit_length()
            self.up, self.down = powers(self.base, size), powers(self.inverse, size)
        return self.up, self.down


_POWERS = Powers()


def word_hashes(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and where each text's words end."""
    signs = np.frombuffer(b" " + b" ".join(data) + b" ", np.uint8)
    blank = _BLANK[signs]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    stops = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    up, down = _POWERS.upto(len(signs))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[signs] * up[: len(signs)], dtype=np.uint64)))
    hashes = mix((sums[stops] - sums[starts]) * down[starts])
    lengths = np.fromiter(map(len, data), np.int64, len(data))
    ends = np.cumsum(lengths + 1)
    return hashes, np.searchsorted(starts, ends, "right")


def shingle_sets(data: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle fingerprints of each text, A-Z lower-cased.

    A text with fewer words than ``width`` has one shingle of all its words; without words, none.
    """
    if not data:
        return []
    hashes, ends = word_hashes([d.lower() for d in data])
    grams = hashes.copy()
    for i in range(1, width):
        # Only starts whose shingle ends in the same text are used below.
        following = np.concatenate((hashes[i:], np.zeros(min(i, len(hashes)), np.uint64)))
        grams = mix(grams) * np.uint64(_BASE) + following
    grams = mix(grams)
    sets, start = [], 0
    for end in ends.tolist():
        if end - start >= width:
            sets.append(np.unique(grams[start : end - width + 1]))
        elif end > start:
            words = hashes[start:end].tobytes()
            sets.append(np.frombuffer(hashlib.blake2b(words, digest_size=8).digest(), np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
        start = end
    return sets


def set_digest(shingles: np.ndarray) -> bytes | None:
    """Digest of a whole set, equal for equal sets; none for the empty one."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None
