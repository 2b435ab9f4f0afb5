"""Token counts by the whole-token shortcut.

Most pre-tokens of a text are vocabulary entries that encode as one token. Which
entries do is proved once from the vocabulary alone; those are counted by looking
them up, and only the rest goes through the merges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ringwatch.llm.tasks import map_batches
from ringwatch.llm.wordbpe import Cached, WordBpe, bpe_of, broadcast_spec


def whole_token_counter(bpe: WordBpe, whole: frozenset[str]) -> Callable[[str], int]:
    """A function that counts the tokens of a text."""

    def count_rest(part: str) -> int:
        return len(bpe.merge(bpe.symbols(part)))

    merged = Cached(count_rest)

    def count_piece(piece: str) -> int:
        return sum(1 if part in whole else merged[part] for part in bpe.parts(piece))

    of_piece = Cached(count_piece)

    def count(text: str) -> int:
        if bpe.is_plain(text):
            return sum(map(of_piece.__getitem__, text.split()))
        return sum(1 if special else of_piece[piece] for piece, special in bpe.chunks(text))

    return count


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    limit: int = 2048,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    A null text is an empty one, with no bytes and no tokens; a null id stays null;
    rows with the same id are counted each for itself; other columns are not read.
    Texts are worked on whole, whatever their length; an empty table gives an empty
    table. One pass, no shuffle.
    """
    spec = broadcast_spec(docs.sparkSession, vocabulary)
    proved = docs.sparkSession.sparkContext.broadcast(bpe_of(spec.value).whole_tokens())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = whole_token_counter(bpe_of(spec.value), proved.value)
        for batch in batches:
            texts = batch.column(1)
            n_tokens = pa.array([count(t) if t else 0 for t in (x.as_py() for x in texts)], pa.int64())
            n_bytes = pa.array([len(t.encode()) if t else 0 for t in (x.as_py() for x in texts)], pa.int64())
            over = pa.array([n > limit for n in n_tokens.to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_bytes, n_tokens, over], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    ids = docs.schema[id_column].dataType.simpleString()
    return map_batches(
        docs.select(id_column, text_column),
        work,
        f"doc_id {ids}, n_bytes long, n_tokens long, over_limit boolean",
    )
