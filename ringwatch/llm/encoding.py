"""BPE encoding and decoding of whole texts.

Every pre-token is merged with a priority queue of merge ranks over a doubly linked
list (:meth:`~ringwatch.llm.wordbpe.WordBpe.merge`); ids are decoded by putting
their vocabulary strings one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ringwatch.llm.tasks import map_batches
from ringwatch.llm.wordbpe import Cached, WordBpe, bpe_of, broadcast_spec

#: Words whose digest forms a task keeps, where other work needs the memory too.
WORDS_KEPT = 1 << 16


def _pieces_of(bpe: WordBpe) -> Callable[[str], list[tuple[int, ...]]]:
    """A function that gives the ids of a text piece by piece."""
    ids_of_part = Cached(bpe.encode_part)
    ids_of = Cached(lambda piece: tuple([i for part in bpe.parts(piece) for i in ids_of_part[part]]))

    def encode(text: str) -> list[tuple[int, ...]]:
        if bpe.is_plain(text):
            return list(map(ids_of.__getitem__, text.split()))
        return [(bpe.special[p],) if special else ids_of[p] for p, special in bpe.chunks(text)]

    return encode


def _renderer(bpe: WordBpe, words_kept: int) -> Callable[[str], tuple[int, str, str]]:
    """A function that gives the number of tokens, the ids as text, and the decoded text.

    Each piece is encoded and decoded once and kept in both forms; neighbours are joined
    by one space in either.
    """
    ids_of_part = Cached(bpe.encode_part, words_kept)

    def forms(ids: list[int]) -> tuple[int, str, str]:
        return len(ids), " ".join([bpe.numbers[i] for i in ids]), bpe.decode(ids)


    def of_new(piece: str) -> tuple[int, str, str]:
        parts = bpe.parts(piece)
        if len(parts) == 1:
            return forms(ids_of_part[parts[0]])
        return forms([i for part in parts for i in ids_of_part[part]])

    of_piece = Cached(of_new, words_kept)

    def render(text: str) -> tuple[int, str, str]:
        if bpe.is_plain(text):
            found = list(map(of_piece.__getitem__, text.split()))
        else:
            found = [forms([bpe.special[p]]) if special else of_piece[p] for p, special in bpe.chunks(text)]
        if not found:
            return 0, "", ""
        counts, numbers, strings = zip(*found)
        if 0 in counts:  # pieces without any token leave no space behind
            found = [form for form in found if form[0]]
            counts, numbers, strings = zip(*found) if found else ((), (), ())
        return sum(counts), " ".join(numbers), " ".join(strings)

    return render


def encode_texts(
    docs: DataFrame,
    vocabulary: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``ids``, the tokens of the whole text.

    A null text is an empty one, with no ids; a null id stays null; rows with the same
    id are encoded each for itself; other columns are not read. An empty table gives
    an empty table. One pass, no shuffle.
    """
    spec = broadcast_spec(docs.sparkSession, vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _pieces_of(bpe_of(spec.value))
        for batch in batches:
            ids = [[i for piece in encode(t.as_py() or "") for i in piece] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return map_batches(docs.select(id_column, text_column), work, f"doc_id {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, ids`` -> ``doc_id, text``: the text the ids stand for. Null ids give an empty text."""
    spec = broadcast_spec(encoded.sparkSession, vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(spec.value)
        for batch in batches:
            texts = [bpe.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_batches(encoded.select("doc_id", "ids"), work, f"doc_id {kind}, text string")


def encoding_digests(
    docs: DataFrame,
    vocabulary: str,
    words_kept: int = WORDS_KEPT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encode and decode in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The digests are those of the decimal ids with single spaces between them, and of
    the decoded text in UTF-8. Cases as in :func:`encode_texts`; an empty text has the
    digests of the empty string. A task keeps the tokens of ``words_kept`` words it has met, in each of two
    generations, a hundred megabytes for 2 ** 18 of them; fewer cost time, not results.
    """
    spec = broadcast_spec(docs.sparkSession, vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = _renderer(bpe_of(spec.value), words_kept)
        for batch in batches:
            counts, id_digests, text_digests = [], [], []
            for cell in batch.column(1):
                count, numbers, strings = render(cell.as_py() or "")
                counts.append(count)
                id_digests.append(hashlib.sha256(numbers.encode()).hexdigest())
                text_digests.append(hashlib.sha256(strings.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_digests), pa.array(text_digests)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return map_batches(
        docs.select(id_column, text_column),
        work,
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
