"""Words of raw texts as hashed numbers, in whole batches."""

from __future__ import annotations

import numpy as np
import xxhash

from ringwatch.llm.wordbpe import Cached

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(29)


def hashed(words: list[bytes], cache: Cached) -> np.ndarray:
    """One 64-bit number per word, looked up in a :func:`hash_cache`."""
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


# A hash is quickly made anew, so that only frequent words are worth their memory.
WORD_ENTRIES = 1 << 16


def hash_cache() -> Cached:
    """A cache of :func:`word_hash`."""
    return Cached(word_hash, WORD_ENTRIES)


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def following(hashes: np.ndarray, order: int) -> np.ndarray:
    """One 64-bit number for each run of ``order`` neighbours; order 1 gives the words themselves, mixed."""
    n = len(hashes) - order + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    mixed = hashes[:n] * _M1
    for k in range(1, order):
        mixed = ((mixed ^ (mixed >> _SHIFT)) * _M2) ^ (hashes[k : k + n] * _M1)
    mixed ^= mixed >> _SHIFT
    return mixed * _M2


def repeated_windows(hashes: np.ndarray, words: list[bytes], width: int) -> int:
    """How many words lie in windows of ``width`` words that a text has more than once.

    Distinct hashes mean distinct windows; where hashes repeat, windows are numbered
    exactly, by doubling their width from the words' own numbers.
    """
    n = len(words) - width + 1
    if n < 2:
        return 0
    rolled = np.sort(following(hashes, width))
    if not (rolled[1:] == rolled[:-1]).any():
        return 0
    number = {}
    ranks = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    have = 1
    while have < width:
        step = min(have, width - have)
        m = len(words) - have - step + 1
        pairs = ranks[:m] * np.int64(len(words) + 1) + ranks[step : step + m]
        ranks = np.unique(pairs, return_inverse=True)[1]
        have += step
    again = np.bincount(ranks)[ranks] > 1
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(again)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + width, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())
