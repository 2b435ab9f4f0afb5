"""Byte-pair encoding with word ends: the vocabulary, its text rules, and the merges.

The vocabulary is a file of a public tokenizer, given by its path. The driver
reads it and sends its text to the tasks (two megabytes, the same for any corpus).
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Any

import regex
from pyspark import Broadcast
from pyspark.sql import SparkSession

# Entries that a task keeps of the words it has already worked on, in each of two generations, and the longest of them.
CACHE_ENTRIES = 1 << 18
CACHED_LENGTH = 64
# Ids are below 2 ** 20 in any vocabulary, places in a pre-token below 2 ** 40.
ID_BITS = 20
PLACE_BITS = 40
PLACE_MASK = (1 << PLACE_BITS) - 1

#: Python splits at these four, the vocabulary's rules do not take them for white space.
_ODD_SPACE = regex.compile("[\x1c-\x1f]")
#: The one letter whose lower case depends on its place in a word for Python, but not for the vocabulary.
_SIGMA = "Σ"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else the next free one from 256 on."""
    prints = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(free)) for b in range(256)]


class WordBpe:
    """One vocabulary: texts to parts, parts to symbols, symbols to ids and back."""

    def __init__(self, spec: str):
        content = json.loads(spec)
        self._spec, self._library = spec, None
        model = content["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.word_end: str = model["end_of_word_suffix"]
        # A pair of ids in one number -> its rank, moved to make room for a place; rank -> the id of what it makes.
        self._ranks: dict[int, int] = {}
        self._merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self._ranks[self.vocab[left] << ID_BITS | self.vocab[right]] = rank << PLACE_BITS
            self._merged.append(self.vocab[left + right])
        split = content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._parts = regex.compile(split)
        self._letters = byte_letters()
        self._byte_ids = [self.vocab[letter] for letter in self._letters]
        self._last_byte_ids = [self.vocab[letter + self.word_end] for letter in self._letters]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in content["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")
        self.strings: dict[int, str] = {i: s for s, i in [*self.vocab.items(), *self.special.items()]}
        self.numbers: dict[int, str] = {i: str(i) for i in self.strings}

    def parts(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings: composed, lower case, split by the pattern."""
        if text.isascii():
            return self._parts.findall(text.lower())
        folded = unicodedata.normalize("NFC", text)
        # Letter by letter: the sigma at the end of a word is no special case here.
        folded = folded.replace(_SIGMA, "σ").lower()
        if any(unicodedata.category(c) == "Cn" for c in folded):
            return self._library_parts(text)
        return self._parts.findall(folded)

    def _library_parts(self, text: str) -> list[str]:
        """The pre-tokens by the rules of the public library itself.

        Signs that Python's tables do not have yet may be letters or numbers for the library,
        or have a lower case there; its tables are of another version of Unicode.
        """
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self._spec)
        folded = self._library.normalizer.normalize_str(text)
        byte_of = {letter: b for b, letter in enumerate(self._letters)}
        found = self._library.pre_tokenizer.pre_tokenize_str(folded)
        return [bytes(byte_of[c] for c in part).decode() for part, _ in found]

    def chunks(self, text: str) -> Iterator[tuple[str, bool]]:
        """A text cut at its white space and special strings, as (piece, whether it is special).

        No pre-token reaches over white space, so that pieces can be encoded alone.
        """
        pieces = self._special.split(text) if "<|" in text else [text]
        for k, piece in enumerate(pieces):
            if k % 2:
                yield piece, True
            elif _ODD_SPACE.search(piece):
                yield piece, False
            else:
                for word in piece.split():
                    yield word, False

    def is_plain(self, text: str) -> bool:
        """Whether ``text.split()`` gives the pieces of :meth:`chunks`, with no special string among them."""
        return "<|" not in text and not _ODD_SPACE.search(text)

    def symbols(self, part: str) -> list[int]:
        """The ids of a pre-token's bytes, that of the last with the word end."""
        data = part.encode()
        ids = list(map(self._byte_ids.__getitem__, data))
        if ids:
            ids[-1] = self._last_byte_ids[data[-1]]
        return ids

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge neighbours, lowest rank first, leftmost first among equals.

        The symbols are a doubly linked list, from which a merge unlinks the right one.
        The queue holds rank and place in one number; an entry is stale, and skipped,
        if the pair at its place has another rank by now.
        """
        n = len(symbols)
        if n < 2:
            return symbols
        rank_of, push, pop, merged = self._ranks.get, heapq.heappush, heapq.heappop, self._merged
        queue = []
        # The entry of the queue that holds for the pair at each place; others of that place are stale.
        valid = [-1] * n
        left = symbols[0]
        for at in range(n - 1):
            right = symbols[at + 1]
            rank = rank_of(left << ID_BITS | right)
            if rank is not None:
                valid[at] = rank = rank | at
                queue.append(rank)
            left = right
        if not queue:
            return symbols
        heapq.heapify(queue)
        symbol = symbols.copy()
        before = list(range(-1, n - 1))
        after = [*range(1, n), -1]
        while queue:
            entry = pop(queue)
            at = entry & PLACE_MASK
            if valid[at] != entry:
                continue
            right_at = after[at]
            symbol[at] = made = merged[entry >> PLACE_BITS]
            symbol[right_at] = valid[right_at] = valid[at] = -1
            after[at] = nxt = after[right_at]
            if nxt >= 0:
                before[nxt] = at
                rank = rank_of(made << ID_BITS | symbol[nxt])
                if rank is not None:
                    valid[at] = rank = rank | at
                    push(queue, rank)
            prev = before[at]
            if prev >= 0:
                rank = rank_of(symbol[prev] << ID_BITS | made)
                if rank is None:
                    valid[prev] = -1
                else:
                    valid[prev] = rank = rank | prev
                    push(queue, rank)
        return [s for s in symbol if s >= 0]

    def encode_part(self, part: str) -> list[int]:
        return self.merge(self.symbols(part))

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text."""
        ids: list[int] = []
        for piece, special in self.chunks(text):
            if special:
                ids.append(self.special[piece])
            else:
                for part in self.parts(piece):
                    ids.extend(self.encode_part(part))
        return ids

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings of the ids. The file names no decoder, so a space stands between them."""
        return " ".join([self.strings[i] for i in ids])

    def whole_tokens(self) -> frozenset[str]:
        """Pre-tokens that are proved to encode alone as one token.

        Of every vocabulary string with a word end the bytes are spelled out and
        merged from scratch; only if one symbol is left, and the text rules leave
        the string as one pre-token, is it a whole token. Needs no corpus.
        """
        byte_of = {letter: b for b, letter in enumerate(self._letters)}
        proved = []
        for string in self.vocab:
            if not string.endswith(self.word_end):
                continue
            try:
                part = bytes(byte_of[c] for c in string[: -len(self.word_end)]).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if part and self.parts(part) == [part] and len(self.merge(self.symbols(part))) == 1:
                proved.append(part)
        return frozenset(proved)


class Cached(dict):
    """A dict that fills itself by a function; what was not asked for during a generation is forgotten.

    Keys longer than ``CACHED_LENGTH`` are worked on each time, so that the number of entries bounds their bytes.
    """

    def __init__(self, make: Callable[[Any], Any], entries: int = CACHE_ENTRIES):
        super().__init__()
        self._make, self._entries, self._older = make, entries, {}

    def __missing__(self, key):
        if len(key) > CACHED_LENGTH:
            return self._make(key)
        if len(self) >= self._entries:
            self._older = dict(self)
            self.clear()
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
        self[key] = value
        return value


@lru_cache(maxsize=2)
def bpe_of(spec: str) -> WordBpe:
    """The vocabulary of a file's text, built once in a Python process."""
    return WordBpe(spec)


def broadcast_spec(spark: SparkSession, vocabulary: str) -> Broadcast:
    """Read the vocabulary file on the driver and send its text to the executors."""
    with open(vocabulary, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())
