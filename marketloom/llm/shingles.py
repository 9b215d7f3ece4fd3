"""Word shingles of whole texts as sets of 64-bit numbers, and their minima under universal hash functions."""

from __future__ import annotations

import numpy as np
import xxhash

KEPT_WORDS = 100_000
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)


class _Words(dict):
    """The number of each word; the first ones met are kept."""

    def __missing__(self, word: bytes) -> int:
        number = xxhash.xxh3_64_intdigest(word)
        if len(self) < KEPT_WORDS:
            self[word] = number
        return number


_WORDS = _Words()


def words(text: str) -> list[bytes]:
    """Runs without ASCII white space, A-Z in lower case: bytes know no other letters or spaces."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def mixed(x: np.ndarray, k: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX[k]
    return (x ^ (x >> np.uint64(29))) * MIX[k ^ 1]


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The sorted numbers of the distinct shingles; a text with fewer words is one shingle, without words none."""
    found = words(text or "")
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=len(found))], np.uint64)
    w = np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))
    n = len(w) - size + 1
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * MIX[0] + (w[i : i + n] ^ (w[i : i + n] >> np.uint64(31))) * MIX[1]
    return np.unique(mixed(out, 2))


class Minima:
    """The smallest value of each of many functions a*x + b (mod 2^64) over a set."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = (rng.integers(0, 1 << 63, bands * rows, np.uint64) << np.uint64(1)) | np.uint64(1)
        self.b = rng.integers(0, 1 << 63, bands * rows, np.uint64)
        self.fold = (rng.integers(0, 1 << 63, rows, np.uint64) << np.uint64(1)) | np.uint64(1)

    def of(self, x: np.ndarray, chunk: int = 2048) -> np.ndarray:
        best = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(x), chunk):
            values = x[None, at : at + chunk] * self.a[:, None] + self.b[:, None]
            best = np.minimum(best, values.min(1))
        return best

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        """One number per band from the minima of its rows and its own place."""
        parts = mixed(minima.reshape(-1, self.bands, self.rows), 0) * self.fold
        keys = parts.sum(2, dtype=np.uint64) + np.arange(self.bands, dtype=np.uint64) * MIX[3]
        return mixed(keys, 2).view(np.int64)
