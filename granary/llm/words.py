"""Words of whole texts as 64-bit hashes, and rolling hashes of word windows."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd multipliers, one for each place in a window.
_PLACES = (np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits depend on all input bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of width words; none for shorter texts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:n] * _PLACES[0]
    for k in range(1, width):
        total += hashes[k : k + n] * _PLACES[k]
    return mixed(total)


def repeated_words(hashes: np.ndarray, width: int) -> int:
    """Number of words that lie in a window found at least twice, the first find included."""
    found = windows(hashes, width)
    if len(found) < 2:
        return 0
    order = np.sort(found)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    begins = np.zeros(len(hashes) + 1, np.int64)
    marked = np.concatenate([[0], np.cumsum(np.isin(found, twice))])
    at = np.arange(len(hashes))
    begins = marked[np.minimum(at + 1, len(found))] - marked[np.minimum(np.maximum(at - width + 1, 0), len(found))]
    return int((begins > 0).sum())
