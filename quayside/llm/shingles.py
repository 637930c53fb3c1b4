"""Word shingles as 64-bit hashes (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

MEMO_WORDS = 200_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHash(dict):
    """word -> 64-bit hash; emptied when full, so its memory is bounded."""

    def __missing__(self, word):
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), elementwise."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int, memo: WordHash) -> np.ndarray:
    """Distinct shingles, sorted.  A-Z are lower-cased, words are runs of
    anything but ASCII white space (what ``bytes`` methods do); a text of fewer
    words is one shingle, a text without words has none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else ()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = min(width, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        out = mix64(out * _STEP + h[i:len(words) - n + 1 + i])
    return np.unique(out)
