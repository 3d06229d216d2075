"""Word-shingle hashes of texts, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

KNOWN_WORDS = 300_000
_A = np.uint64(0xBF58476D1CE4E5B9)
_B = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """Hashes of words, made when they are first asked for."""

    def __missing__(self, word: str) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


class Shingler:
    """Hashes of each run of ``width`` words; words are split at white space
    and lower-cased. A text of fewer words, but one at least, is one shingle."""

    def __init__(self, width: int) -> None:
        self.width = width
        self._known = _Hashes()

    def words(self, words: list[str]) -> np.ndarray:
        known = self._known
        if len(known) > KNOWN_WORDS:
            known.clear()
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def sequence(self, text: str) -> np.ndarray:
        """Shingle hashes in text order."""
        words = text.lower().split()
        if not words:
            return np.empty(0, np.uint64)
        codes = self.words(words)
        n = min(self.width, len(codes))
        rolled = codes[:len(codes) - n + 1].copy()
        for k in range(1, n):
            rolled = rolled * _STEP + codes[k:len(codes) - n + 1 + k]
        return mix(rolled + np.uint64(n))

    def sequences(self, texts: list[str]) -> list[np.ndarray]:
        """The same of each of some texts."""
        words = [text.lower().split() for text in texts]
        sizes = [len(x) for x in words]
        codes = self.words([w for x in words for w in x])
        rolled = codes[:max(0, len(codes) - self.width + 1)].copy()
        for k in range(1, self.width):
            rolled = rolled * _STEP + codes[k:k + len(rolled)]
        rolled = mix(rolled + np.uint64(self.width))
        out, start = [], 0
        for text, n in zip(texts, sizes):
            out.append(rolled[start:start + n - self.width + 1] if n >= self.width else self.sequence(text))
            start += n
        return out
