"""Word shingle sets of texts as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

SIZE = 5
CACHE_ENTRIES = 150_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed shuffle of the bits of 64-bit numbers (public-domain splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str, hashes: WordHashes, size: int = SIZE) -> np.ndarray:
    """Sorted distinct shingle hashes: none without words, one for fewer words than ``size``."""
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    size = min(size, len(w))
    n = len(w) - size + 1
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + mixed(w[i : i + n] + np.uint64(i + 1))
    return np.unique(mixed(h))


def signature(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two signed 64-bit numbers."""
    d = xxhash.xxh3_128_digest(tokens.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)
