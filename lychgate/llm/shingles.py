"""Word shingles as 64-bit hashes, from whole texts.

Words are runs of bytes other than the space and \\x09-\\x0D of the text in UTF-8, A-Z in lower case.
A text of fewer than WORDS words is one shingle, its whole sequence; one without words has none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

WORDS = 5

_rng = np.random.Generator(np.random.PCG64(20240601))
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(h: np.ndarray, words: int = WORDS) -> np.ndarray:
    """One hash a shingle in order of place, from the hashes of words."""
    n = len(h)
    if n < words:
        return mix((h * _PLACE[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)) if n else h
    s = h[: n - words + 1] * _PLACE[0]
    for i in range(1, words):
        s += h[i : n - words + 1 + i] * _PLACE[i]
    return mix(s + np.uint64(words))


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct shingle hashes in ascending order."""
    return np.unique(shingle_hashes(word_hashes(words_of(text))))


def set_key(s: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two ascending arrays without repeats."""
    c = np.concatenate([a, b])
    c.sort(kind="stable")
    return int(np.count_nonzero(c[1:] == c[:-1]))
