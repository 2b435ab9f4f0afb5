"""Quality rules: a few counts with fixed limits, then a likelihood ratio of hashed n-grams.

Two multinomials over hashed n-grams are counted, one from all trusted documents but those
held out and one from the whole raw corpus. A document's score is the mean log ratio of its
n-grams, so that its length does not matter; it is kept if the score reaches a limit.

One trusted document of ``HELD_OUT``, by a hash of its id, is not counted. What such documents
score shows how far clean text that was never counted falls in a corpus of this size: the
limit is the ``HELD_SHARE`` quantile of their scores, or ``MIN_SCORE`` if that is lower.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.tasks import map_batches, quoted
from ringwatch.llm.words import following, hash_cache, hashed, repeated_windows
from ringwatch.session import store

#: Of so many trusted documents one is held out for the limit.
HELD_OUT = 8
#: The share of held-out documents that may score below the limit.
HELD_SHARE = 0.001
#: Scores are counted in steps of this size, so that the quantile depends on no order of rows.
STEP = 0.001
BUCKET_BITS = 16
ORDERS = (1, 2)
#: The highest limit: least mean log ratio per n-gram of a document that is kept, in nats.
MIN_SCORE = -0.12
#: N-grams that are added to each bucket on both sides, so that buckets with few of them say little.
PRIOR = 10.0
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8

_SYMBOLS = b"#*$%&|<>"
# What is left without these bytes are the first bytes of the code points of words.
_NOT_IN_WORDS = bytes([0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)])
# N-grams that are gathered before they are counted.
_BLOCK = 1 << 20
# What a text is counted for.
_RAW, _TRUSTED, _HELD = 0, 1, 2

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def held_out(id_column: Column) -> Column:
    """Whether a trusted document is left out of the counts."""
    return F.pmod(F.xxhash64(id_column, F.lit("held out")), F.lit(HELD_OUT)) == 0


def _buckets(hashes: np.ndarray, orders: Sequence[int], bits: int) -> np.ndarray:
    grams = np.concatenate([following(hashes, order) for order in orders])
    return (grams >> np.uint64(64 - bits)).astype(np.int64)


def gather(
    docs: DataFrame, trusted: DataFrame, id_column: str, text_column: str, orders: Sequence[int], bits: int
) -> DataFrame:
    """What one pass over the corpus leaves: ``bucket, trusted, raw`` of each task, and ``text`` of held-out documents.

    ``trusted`` holds ids in its only column; a document counts once however often its id is named.
    Its texts are found by a merge join whatever the number of ids, so that cost grows evenly.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = hash_cache()
        counts = np.zeros((2, 1 << bits), dtype=np.int64)
        waiting: list[list[np.ndarray]] = [[], []]
        size = 0

        def flush() -> None:
            for side in (_RAW, _TRUSTED):
                if waiting[side]:
                    counts[side] += np.bincount(np.concatenate(waiting[side]), minlength=1 << bits)
                    waiting[side].clear()

        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for text, side in zip(texts, batch.column(1).to_pylist()):
                if side == _HELD:
                    continue
                found = _buckets(hashed((text.as_py() or b"").split(), cache), orders, bits)
                waiting[side].append(found)
                size += len(found)
                if size > _BLOCK:
                    flush()
                    size = 0
            held = batch.column(0).filter(pc.equal(batch.column(1), _HELD))
            if len(held):
                nothing = pa.nulls(len(held), pa.int64())
                yield pa.RecordBatch.from_arrays([nothing, nothing, nothing, held], names)
        flush()
        seen = np.flatnonzero(counts.any(axis=0))
        columns = [pa.array(c) for c in (seen, counts[_TRUSTED][seen], counts[_RAW][seen])]
        yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(seen), pa.string())], names)

    names = ["bucket", "trusted", "raw", "text"]
    slim = docs.select(F.col(quoted(id_column)).alias("doc_id"), F.col(quoted(text_column)).alias("text"))
    wanted = trusted.toDF("id").hint("merge")
    chosen = slim.join(wanted, slim["doc_id"] == wanted["id"], "left_semi").select(
        "text", F.when(held_out(F.col("doc_id")), F.lit(_HELD)).otherwise(F.lit(_TRUSTED))
    )
    every = slim.select("text", F.lit(_RAW)).union(chosen)
    return store(map_batches(every, work, "bucket long, trusted long, raw long, text string"), "quality-counts")


def ngram_counts(gathered: DataFrame) -> DataFrame:
    """``bucket, trusted, raw``: how often the n-grams of each hash bucket occur."""
    parts = gathered.filter("bucket is not null")
    return parts.groupBy("bucket").agg(F.sum("trusted").alias("trusted"), F.sum("raw").alias("raw"))


def log_ratios(counts: DataFrame, bits: int) -> np.ndarray:
    """Per bucket, the log of the trusted over the raw probability.

    Raw counts are scaled to the trusted total, then ``PRIOR`` is added to both. At most
    2 ** ``bits`` rows come to the driver. Without trusted n-grams all ratios are 0.
    """
    rows = counts.toPandas()
    ratios = np.zeros(1 << bits)
    trusted, raw = rows["trusted"].to_numpy(dtype=float), rows["raw"].to_numpy(dtype=float)
    if trusted.sum():
        expected = raw * (trusted.sum() / raw.sum())
        ratios[rows["bucket"]] = np.log((trusted + PRIOR) / (expected + PRIOR))
    return ratios


def base_counts(text: bytes, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, _NOT_IN_WORDS)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_windows(hashes, words, WINDOW),
    )


class Rules:
    """The verdict on a text, for one table of log ratios."""

    def __init__(self, ratios: np.ndarray, orders: Sequence[int], bits: int, min_score: float):
        self._ratios, self._orders, self._bits, self._min_score = ratios, orders, bits, min_score
        self._cache = hash_cache()

    def judge(self, text: bytes | None) -> tuple:
        text = text or b""
        words = text.split()  # bytes are split at ASCII white space only
        hashes = hashed(words, self._cache)
        counts = base_counts(text, words, hashes)
        failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEATED_PERCENT * counts[0]
        found = self._ratios[_buckets(hashes, self._orders, self._bits)]
        # Rounded, so that no order of summation can flip a verdict.
        score = round(float(found.mean()), 9) if len(found) else 0.0
        return (*counts, score, failed, not failed and score >= self._min_score)


def score_limit(texts: DataFrame, ratios: Broadcast, min_score: float) -> float:
    """``min_score`` or, if lower, the ``HELD_SHARE`` quantile of the scores of ``texts``, cut to whole steps.

    Texts that the fixed limits reject say nothing about scores. Only counts of scores come to
    the driver: their number is bounded by the range of log ratios over ``STEP``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = Rules(ratios.value, ORDERS, BUCKET_BITS, min_score)
        steps: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                *_, score, failed, _kept = rules.judge(text.as_py())
                if not failed:
                    steps[math.floor(score / STEP)] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(steps), pa.int64()), pa.array(list(steps.values()), pa.int64())], ["step", "n"]
        )

    counts = map_batches(texts, work, "step long, n long").groupBy("step").agg(F.sum("n").alias("n"))
    rows = sorted((r["step"], r["n"]) for r in counts.collect())
    allowed = math.floor(HELD_SHARE * sum(n for _, n in rows))
    for step, n in rows:
        if n > allowed:
            return min(min_score, step * STEP)
        allowed -= n
    return min_score


def _fitted(docs, trusted, id_column, text_column, min_score) -> dict:
    gathered = gather(docs, trusted, id_column, text_column, ORDERS, BUCKET_BITS)
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(ngram_counts(gathered), BUCKET_BITS))
    limit = score_limit(gathered.filter("bucket is null").select("text"), ratios, min_score)
    return {"ratios": ratios, "orders": ORDERS, "bits": BUCKET_BITS, "min_score": limit}


def judge_quality(
    docs: DataFrame,
    trusted: DataFrame,
    min_score: float = MIN_SCORE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, score, base_failed, kept.

    ``trusted`` has the ids of documents of known good quality in its only column; repeated
    ids count once. ``min_score`` is the highest limit, see :func:`score_limit`. A null or empty text has all counts
    0 and score 0 and fails for want of words. Null ids are judged like others and are
    never trusted; rows with the same id are judged each for itself. Without trusted
    documents all scores are 0. An empty table gives an empty table.
    """
    options = _fitted(docs, trusted, id_column, text_column, min_score)
    ratios = options.pop("ratios")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = Rules(ratios.value, **options)
        names = [part.split()[0] for part in schema.split(", ")]
        for batch in batches:
            rows = [rules.judge(t.as_py()) for t in batch.column(1).cast(pa.binary())]
            columns = list(zip(*rows)) if rows else [[]] * (len(names) - 1)
            kinds = [*[pa.int64()] * 5, pa.float64(), pa.bool_(), pa.bool_()]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, {COUNTS}, score double, base_failed boolean, kept boolean"
    return map_batches(docs.select(id_column, text_column), work, schema)


def keep_quality(
    docs: DataFrame,
    trusted: DataFrame,
    min_score: float = MIN_SCORE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that :func:`judge_quality` keeps, with all their columns."""
    options = _fitted(docs, trusted, id_column, text_column, min_score)
    ratios = options.pop("ratios")
    at = docs.columns.index(text_column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = Rules(ratios.value, **options)
        for batch in batches:
            verdicts = [rules.judge(t.as_py())[-1] for t in batch.column(at).cast(pa.binary())]
            yield batch.filter(pa.array(verdicts, pa.bool_()))

    return map_batches(docs, work, docs.schema)
