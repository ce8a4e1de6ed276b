"""Word shingles of whole texts as sets of 64-bit hashes, and their minhash symbols."""

from __future__ import annotations

import numpy as np
import xxhash

from panelyze.llm.common import mix64

SHINGLE = 5
CACHED_WORDS = 400_000
_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
_STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes:
    """64-bit hashes of words, remembered from call to call."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        out = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        return np.array(out, dtype=np.uint64)


def words_of(text: str | None, lower: bool = True) -> list[bytes]:
    """Words of a text; bytes.split() parts at space and the ASCII controls 9-13, and nowhere else."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.translate(_LOWER) if lower else raw).split()


def sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    h = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        h = mix64(h * _STEP + words[i : len(words) - n + 1 + i])
    return h


def shingle_set(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Distinct shingle hashes, sorted; a text of fewer words is one shingle, of none has none."""
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(sequence_hashes(words, min(n, len(words))))


def minhash(sets: list[np.ndarray], k: int) -> np.ndarray:
    """``[set, k]`` 16-bit minhash symbols of non-empty sets."""
    out = np.empty((len(sets), k), np.uint16)
    if not sets:
        return out
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    rng = np.random.default_rng(1729)
    for j in range(k):
        a, b = rng.integers(1, 1 << 63, 2, dtype=np.uint64)
        h = (flat ^ b) * (a | np.uint64(1))
        h ^= h >> np.uint64(29)
        low = np.minimum.reduceat(h, starts)
        out[:, j] = (mix64(low) >> np.uint64(48)).astype(np.uint16)
    return out
