"""Words between white space and their 64-bit hashes, for a whole batch of texts at once."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np

BLOCK = 1 << 20  # bytes hashed at once; longer words are hashed one by one
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_LENGTH = np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd number and of its inverse, modulo 2^64."""
    result = []
    for factor in (base, pow(base, -1, 2**64)):
        steps = np.full(n + 1, factor, np.uint64)
        steps[0] = 1
        result.append(np.multiply.accumulate(steps))
    return result[0], result[1]


_UP, _DOWN = powers(_BASE, BLOCK)


@dataclass
class Words:
    data: bytes
    starts: np.ndarray  # byte offsets
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # of each document: its first word; one more entry at the end

    def of(self, document: int) -> slice:
        return slice(int(self.first[document]), int(self.first[document + 1]))

    def document_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split_words(texts: list[bytes], lower: bool = False) -> Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of each text, A-Z lower-cased on request."""
    data = b"\n".join(texts)
    if lower:
        data = data.lower()  # of bytes: ASCII letters only
    space = np.concatenate(([True], _SPACE[np.frombuffer(data, np.uint8)], [True]))
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    ends = np.flatnonzero(~space[:-1] & space[1:])
    offsets = np.cumsum([0] + [len(text) + 1 for text in texts])
    return Words(data, starts, ends, _hashes(data, starts, ends), np.searchsorted(starts, offsets))


def _hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    raw, out, i = np.frombuffer(data, np.uint8), np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + BLOCK, "right"))
        if j <= i:
            digest = hashlib.blake2b(data[base : int(ends[i])], digest_size=8).digest()
            out[i] = np.frombuffer(digest, np.uint64)[0]
            i += 1
            continue
        piece = raw[base : int(ends[j - 1])]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[piece] * _UP[: len(piece)], dtype=np.uint64)))
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[b] - sums[a]) * _DOWN[a] + _LENGTH * (b - a).astype(np.uint64))
        i = j
    return out


def grams(hashes: np.ndarray, n: int, seed: int = 0x632BE59BD9B4E019) -> np.ndarray:
    """A hash of every n consecutive words, whatever documents they are of."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for j in range(n):
        total = total * np.uint64(seed) + hashes[j : len(hashes) - n + 1 + j]
    return mix(total)


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """The distinct n-word shingles of one document, sorted; with fewer words, the whole sequence is one."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(grams(hashes, min(n, len(hashes))) + np.uint64(min(n, len(hashes))))
