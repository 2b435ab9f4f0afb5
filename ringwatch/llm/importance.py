"""Importance resampling of documents towards a target, on hashed word n-grams.

Runs of one to three words are hashed to buckets by the CRC-32 of their bytes
(:mod:`~ringwatch.llm.span_crc`). Both sides are counted by bucket, summed in each task
first; a bucket's gain is the log of the target's smoothed share over the corpus's. A
document's score is the sum of its gains plus Gumbel noise from a hash of its id, and
the highest scores are drawn: a sample without replacement by importance. Ranks come
from a range sort of the documents' scores, never from one task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.decontamination import folded_words
from ringwatch.llm.span_crc import span_crcs
from ringwatch.llm.tasks import map_batches, quoted
from ringwatch.operators.ordered import row_numbers
from ringwatch.session import store

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
# Bytes of text whose features are made at once; a longer text is one block.
_BLOCK = 1 << 18


def text_blocks(texts: Iterator[bytes | None]) -> Iterator[list[list[bytes]]]:
    """The words of texts, in blocks of bounded size."""
    block, size = [], 0
    for text in texts:
        block.append(folded_words(text))
        size += len(text or b"")
        if size >= _BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def block_features(block: list[list[bytes]], longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The buckets of all runs of 1, 2, ... words of a block, and the text of each run by its number."""
    sizes = np.array([len(words) for words in block], dtype=np.int64)
    text = np.repeat(np.arange(len(block)), sizes)
    data = np.frombuffer(b" ".join([w for words in block for w in words]), dtype=np.uint8)
    if not len(text):
        return
    spaces = np.flatnonzero(data == 0x20)
    starts = np.concatenate([[0], spaces + 1])
    ends = np.concatenate([spaces, [len(data)]])
    for run in range(1, longest + 1):
        n = len(text) - run + 1
        if n <= 0:
            return
        within = np.flatnonzero(text[:n] == text[run - 1 :])
        found = span_crcs(data, starts[within], ends[within + run - 1] - starts[within])
        yield (found % np.uint32(buckets)).astype(np.int64), text[within]


def feature_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows of the one column of ``texts`` fall into each bucket; ``buckets`` rows come back."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            cells = (t.as_py() for t in batch.column(0).cast(pa.binary()))
            for block in text_blocks(cells):
                for found, _ in block_features(block, longest, buckets):
                    counts += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["bucket", "n"])

    counts = np.zeros(buckets, dtype=np.int64)
    parts = map_batches(texts, work, "bucket long, n long")
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """A thousandfold log ratio per bucket, with one feature added to each bucket of both sides, cut down to a whole number."""
    more = float(len(target))
    all_target, all_corpus = float(target.sum()), float(corpus.sum())
    ratios = [
        (t + 1.0) * (all_corpus + more) / ((s + 1.0) * (all_target + more))
        for t, s in zip(target.tolist(), corpus.tolist())
    ]
    # The C library's logarithm: vectorised ones may differ in the last digit.
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def gumbel_noise(key: str) -> int:
    """A thousandfold Gumbel number, cut down, from the first 32 bits of a key's SHA-256."""
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(
    docs: DataFrame,
    gains: np.ndarray,
    longest: int = LONGEST,
    seed: int = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of each row."""
    buckets = len(gains)
    sent = docs.sparkSession.sparkContext.broadcast(gains)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weights = [], [], []
            for block in text_blocks(t.as_py() for t in batch.column(2).cast(pa.binary())):
                features = np.zeros(len(block), dtype=np.int64)
                weight = np.zeros(len(block), dtype=np.int64)
                for found, text in block_features(block, longest, buckets):
                    features += np.bincount(text, minlength=len(block))
                    first = np.flatnonzero(np.diff(text, prepend=-1))
                    weight[text[first]] += np.add.reduceat(sent.value[found], first) if len(first) else 0
                n_words.extend(map(len, block))
                n_features.extend(features.tolist())
                weights.extend(weight.tolist())
            noise = [gumbel_noise(f"{seed}:{key or ''}") for key in batch.column(1).to_pylist()]
            scores = [w + g for w, g in zip(weights, noise)]
            columns = [pa.array(c, pa.int64()) for c in (n_words, n_features, weights, scores)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    kind = docs.schema[id_column].dataType.simpleString()
    key = F.col(quoted(id_column))
    slim = docs.select(key.alias("id"), key.cast("string").alias("key"), F.col(quoted(text_column)).alias("text"))
    schema = f"doc_id {kind}, n_words long, n_features long, weight long, score long"
    return map_batches(slim, work, schema)


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight, score, rank.

    ``rank`` is 1, 2, 3 ... for the ``percent`` of the documents with at least ``min_words``
    words that score highest (cut down to a whole number), by falling score and rising id,
    a null id last; it is null for all others.

    Null and empty texts have no words, weight 0 and a score of noise alone; the noise of
    a null id is that of an empty one; rows with the same id share their noise and are
    scored and ranked each for itself. An empty table gives an empty table; an empty
    target favours what the corpus has least. Two passes over the texts; only the bucket
    counts (``buckets`` rows) go to the driver and back.
    """
    corpus = feature_counts(docs.select(F.col(quoted(text_column))), longest, buckets)
    wanted = feature_counts(target.select(F.col(quoted(target_text_column))), longest, buckets)
    gains = bucket_gains(wanted, corpus)
    scored = store(score_documents(docs, gains, longest, seed, id_column, text_column), "importance-scores")
    enough = F.col("n_words") >= min_words
    eligible = scored.filter(enough)
    drawn = percent * eligible.count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_words", "n_features", "weight"]
    placed = row_numbers(eligible, order).withColumn("rank", F.when(F.col("row_no") <= drawn, F.col("row_no")))
    others = scored.filter(~enough).withColumn("rank", F.lit(None).cast("long"))
    return placed.drop("row_no").unionByName(others)
