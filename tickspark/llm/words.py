"""Words as bytes, and their 64-bit keys."""

from __future__ import annotations

import numpy as np
import xxhash

_CACHE_WORDS = 200_000


class _Keys(dict):
    """Keys of the words seen last, one table a Python process whatever operators it runs."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        key = self[word] = xxhash.xxh3_64_intdigest(word)
        return key


_keys = _Keys()


def words_of(text: str, lower: bool = False) -> list[bytes]:
    """Runs of bytes other than space and \\x09 to \\x0D; ``lower`` maps A-Z to a-z, nothing else."""
    data = text.encode("utf-8", "replace")
    return (data.lower() if lower else data).split()


def keys_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_keys.__getitem__, words), np.uint64, len(words))
