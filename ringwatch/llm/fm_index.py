"""An FM-index over the words of a shard of documents, in numpy.

The shard's words are numbers from 1 on, a 0 ends each document. Suffixes are sorted
completely, where two ends of documents differ by their place, so that no comparison
runs over an end. The last column of the sorted rotations is kept as a wavelet tree
(its levels side by side, zeros before ones on each), with rank support from popcounts;
every ``SAMPLE``-th text position and the start of each document are kept as sampled
suffix positions. The words themselves are not stored in any other way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Distance of sampled text positions.
SAMPLE = 16


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The places of ``text`` in the order of their suffixes; ``text`` ends with 0.

    Prefix doubling in which only places that still share their rank are sorted again.
    """
    n = len(text)
    ends = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + (len(ends) - 1)
    rank[ends] = np.arange(len(ends))
    width = int(rank.max()).bit_length()
    have = max(1, min(n, 62 // max(width, 1)))
    key = rank.copy()
    for k in range(1, have):
        key <<= width
        key[: n - k] |= rank[k:]
    order = np.argsort(key)
    key = key[order]
    places = np.arange(n)
    while True:
        # ``places`` are the slots of ``order`` that were sorted last; equal keys stay one group.
        first = np.concatenate([[True], key[1:] != key[:-1]])
        starts = np.flatnonzero(first)
        rank[order[places]] = places[starts][np.cumsum(first) - 1]
        sizes = np.diff(np.append(starts, len(places)))
        places = places[np.repeat(sizes > 1, sizes)]
        if not len(places):
            return order
        shared = order[places]
        key = rank[shared] << 32 | rank[shared + have]
        again = np.argsort(key)
        order[places] = shared[again]
        key = key[again]
        have *= 2


class Bits:
    """A row of bits with the number of ones before any place."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self._before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @staticmethod
    def packed(bits: np.ndarray) -> np.ndarray:
        """Sixty-four bits a number, the first one lowest; one number more than needed, so that ranks may ask for the end."""
        packed = np.packbits(bits, bitorder="little")
        room = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)
        room[: len(packed)] = packed
        return room.view(np.uint64)

    def at(self, place: np.ndarray) -> np.ndarray:
        return (self.words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) != 0

    def ones_before(self, place: np.ndarray) -> np.ndarray:
        block = place >> 6
        below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self._before[block] + np.bitwise_count(self.words[block] & below)


@dataclass
class FmParts:
    """What an index consists of, ready to be stored."""

    counts: np.ndarray  # occurrences of each symbol
    levels: np.ndarray  # one row of packed bits per level, highest bit first
    marks: np.ndarray  # packed bits: rows whose text position is sampled
    samples: np.ndarray  # the text positions of these rows


def build_index(text: np.ndarray, n_symbols: int) -> FmParts:
    """The index of ``text``, whose symbols are below ``n_symbols``."""
    order = suffix_order(text)
    last = text[order - 1]
    marked = (order % SAMPLE == 0) | (last == 0)
    height = max(int(n_symbols - 1).bit_length(), 1)
    levels = []
    current = last.astype(np.uint32)
    for level in range(height - 1, -1, -1):
        ones = (current >> np.uint32(level)) & np.uint32(1) != 0
        levels.append(Bits.packed(ones))
        current = np.concatenate([current[~ones], current[ones]])
    return FmParts(
        np.bincount(text, minlength=n_symbols).astype(np.uint32),
        np.stack(levels),
        Bits.packed(marked),
        order[marked].astype(np.uint32),
    )


class FmIndex:
    """Search in the parts of an index."""

    def __init__(self, parts: FmParts):
        counts = parts.counts.astype(np.int64)
        self._smaller = np.concatenate([[0], np.cumsum(counts)])
        self._levels = [Bits(words) for words in parts.levels]
        n = int(counts.sum())
        self._zeros = [n - int(np.bitwise_count(words).sum()) for words in parts.levels]
        self._marks, self._samples = Bits(parts.marks), parts.samples
        # After the last level symbols stand in the order of their reversed bits.
        symbols = np.arange(len(counts))
        backwards = np.zeros(len(counts), dtype=np.int64)
        for level in range(len(self._levels)):
            backwards |= ((symbols >> level) & 1) << (len(self._levels) - 1 - level)
        order = np.argsort(backwards)
        self._first = np.empty(len(counts), dtype=np.int64)
        self._first[order] = np.concatenate([[0], np.cumsum(counts[order])[:-1]])

    def _rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the last column before a place."""
        for k, level in enumerate(self._levels):
            one = (symbol >> (len(self._levels) - 1 - k)) & 1 != 0
            ones = level.ones_before(place)
            place = np.where(one, self._zeros[k] + ones, place - ones)
        return place - self._first[symbol]

    def _back(self, row: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that are longer by the symbol before them."""
        place, symbol = row, np.zeros_like(row)
        for k, level in enumerate(self._levels):
            one, ones = level.at(place), level.ones_before(place)
            place = np.where(one, self._zeros[k] + ones, place - ones)
            symbol = symbol << 1 | one
        return self._smaller[symbol] + place - self._first[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that start with each phrase, found backwards.

        A phrase is a line of symbols, filled up with zeros at its front; the symbol
        -1 stands for a word that the shard does not have.
        """
        low = np.zeros(len(phrases), dtype=np.int64)
        high = low.copy()
        alive = np.flatnonzero((phrases >= 0).all(axis=1) & (phrases[:, -1:] > 0).all(axis=1))
        symbols = phrases[alive].astype(np.int64)
        a, b = self._smaller[symbols[:, -1]], self._smaller[symbols[:, -1] + 1]
        for column in range(symbols.shape[1] - 2, -1, -1):
            symbol = symbols[:, column]
            more = symbol > 0
            both = self._rank(np.tile(symbol, 2), np.concatenate([a, b]))
            a = np.where(more, self._smaller[symbol] + both[: len(a)], a)
            b = np.where(more, self._smaller[symbol] + both[len(b) :], b)
            found = a < b
            alive, symbols, a, b = alive[found], symbols[found], a[found], b[found]
        low[alive], high[alive] = a, b
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of rows: back until a sampled position, then forward by the steps made."""
        position = np.zeros(len(rows), dtype=np.int64)
        open_, row, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(open_):
            known = self._marks.at(row)
            position[open_[known]] = self._samples[self._marks.ones_before(row[known])].astype(np.int64) + steps
            open_, row = open_[~known], row[~known]
            row, steps = self._back(row), steps + 1
        return position
