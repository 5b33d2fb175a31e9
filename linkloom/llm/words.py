"""Words of a text and stable 64-bit word hashes for the Python side of operators."""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np

WORD = re.compile(r"\w+")
CACHE_WORDS = 400_000  # memory bound of a worker's word cache; a full cache is emptied

_MASK = (1 << 64) - 1


def words(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores."""
    return WORD.findall(text.lower()) if text else []


def hash64(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little")


class WordHashes:
    """64-bit hashes of words, the same in every process."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def array(self, ws: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        try:
            return np.array([known[w] for w in ws], dtype=np.uint64)
        except KeyError:
            for w in ws:
                if w not in known:
                    known[w] = hash64(w.encode("utf-8", "surrogatepass"))
            return np.array([known[w] for w in ws], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive values; fewer than k values make one shingle."""
    if not len(h):
        return h
    n = max(1, len(h) - k + 1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(min(k, len(h))):
        out = mix(out + h[j:j + n] + np.uint64(j + 1))
    return out
