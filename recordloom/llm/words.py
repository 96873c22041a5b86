"""Words and hashed word shingles of one text, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from .work import kept_by_worker

_MIX = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


class WordHashes(dict):
    """64-bit hash of each word seen, so that a frequent word is hashed once per worker."""

    MOST = 500_000  # memory only: beyond it the words are forgotten and hashed anew

    def __missing__(self, word: bytes | str) -> int:
        if len(self) >= self.MOST:
            self.clear()
        coded = word.encode("utf-8", "surrogatepass") if isinstance(word, str) else word
        value = self[word] = xxhash.xxh3_64_intdigest(coded)
        return value


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, A-Z in lower case; whole text, null has none."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(kept_by_worker("words", WordHashes).__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _HALF)) * _MIX
    values = (values ^ (values >> _HALF)) * _MIX
    return values ^ (values >> _HALF)


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words; a shorter sequence is one shingle, none has none."""
    width = min(width, len(hashes))
    if not width:
        return hashes
    count = len(hashes) - width + 1
    found = hashes[:count]
    for k in range(1, width):
        found = mixed(found) + hashes[k : k + count]
    return mixed(found)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    return np.unique(shingle_hashes(word_hashes(words_of(text)), width))
