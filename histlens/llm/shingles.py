"""Word shingles of whole texts as 64-bit numbers (numpy, inside tasks).

Words are runs of bytes other than space and \\t\\n\\v\\f\\r after lower-casing
A-Z.  Two different shingles get the same number with probability 2^-64, which
is neglected: within one pair of documents it is far below 10^-9.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import xxhash

WORDS = 5
_C = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


# Spark starts all its Python workers with one fixed hash seed, so that the built-in hash of bytes (SipHash, 64
# bits) agrees between them; where hashes are randomised, a slower one serves.
_word_hash = xxhash.xxh64_intdigest if sys.flags.hash_randomization else hash
_KIND = np.uint64 if sys.flags.hash_randomization else np.int64


class Shingler:
    def __init__(self, words: int = WORDS):
        self.k = words

    def __call__(self, text: bytes) -> np.ndarray:
        """Sorted distinct shingle numbers; a text of fewer words is one shingle, no words none."""
        ws = text.lower().split()
        if not ws:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(_word_hash, ws), _KIND, len(ws)).view(np.uint64)
        k, n = self.k, len(h)
        if n < k:
            return _mix((h * _C[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
        s = h[: n - k + 1] * _C[0]
        for j in range(1, k):
            s = s + h[j : n - k + 1 + j] * _C[j]
        s = _mix(s)
        s.sort()
        new = np.ones(len(s), bool)
        np.not_equal(s[1:], s[:-1], out=new[1:])
        return s[new]


def set_id(tokens: np.ndarray) -> int:
    """63-bit number of a whole set (equal sets, equal numbers)."""
    d = hashlib.blake2b(tokens.tobytes(), digest_size=8).digest()
    return int.from_bytes(d, "little") >> 1
