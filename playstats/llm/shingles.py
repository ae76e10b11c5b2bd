"""Word-shingle sets and MinHash signatures of whole texts, inside tasks.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased (the ASCII rules of Python's
``bytes.lower`` and ``bytes.split``). A shingle is ``width`` words in a row; with fewer words the
whole sequence is one. Shingles are 64-bit hashes, so a set comparison is exact unless two
different shingles of two compared texts share all 64 bits.
"""

from __future__ import annotations

import numpy as np
import xxhash

CACHE_WORDS = 200_000      # word hashes kept a worker; the table is emptied beyond it


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h
        return h


_WORDS = _WordHash()
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every bit."""
    x = x ^ (x >> _S33)
    x = x * _MIX1
    x = x ^ (x >> _S33)
    x = x * _MIX2
    return x ^ (x >> _S33)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes; empty without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    k = min(width, len(h))
    with np.errstate(over="ignore"):
        out = h[:len(h) - k + 1].copy()
        for i in range(1, k):
            out = out * _ODD + h[i:len(h) - k + 1 + i]
        return np.unique(mix64(out + np.uint64(k)))


def multipliers(n: int) -> np.ndarray:
    """The fixed odd multipliers of ``n`` MinHash functions."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * _ODD) | np.uint64(1)


def signature(shingles: np.ndarray, mult: np.ndarray) -> np.ndarray:
    """MinHash signature: for each multiplier the top 32 bits of the smallest product."""
    low = np.full(len(mult), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 2048):
            part = shingles[at:at + 2048]
            np.minimum(low, (mult[:, None] * part[None, :]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def band_keys(sigs: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key a band of ``rows`` signature values (documents x bands)."""
    n, k = sigs.shape
    parts = sigs.reshape(n, k // rows, rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.arange(k // rows, dtype=np.uint64)[None, :] * _ODD + np.uint64(1)
        for i in range(rows):
            key = mix64(key * _ODD + parts[:, :, i])
    return key.view(np.int64)
