"""Logistic regression on hashed n-grams with follow-the-regularised-leader updates.

A document is a sparse vector of hashed word n-grams. Weights are learned coordinate
by coordinate (FTRL-proximal with L1 and L2) and a document is scored by the sparse
dot product of its n-grams with them.

Learning uses a bounded sample of the labelled rows (``rows`` below). The sample is dealt
to a fixed number of tasks; each learns from its share and the weights are averaged.
No task ever holds more than the bound; scores are made for every document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.tasks import map_batches, quoted
from ringwatch.llm.wordbpe import Cached
from ringwatch.llm.words import following, hash_cache, hashed, word_hash
from ringwatch.session import store

#: Labelled rows that are learned from at most (a few more by chance of the hash).
TRAIN_ROWS = 16_000
#: Tasks that learn side by side. More are faster and, as measured, less accurate.
LEARNERS = 1
#: Tasks at most that write the sample. More only make small files, each of which starts a helper process
#: on local disks.
SAMPLE_TASKS = 16
BITS = 18
#: Runs of letters and digits (with all bytes beyond ASCII), and runs of other signs.
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\s]+")
_SAME = b"\x00same"


@dataclass(frozen=True)
class Ftrl:
    """Rates and penalties of the updates."""

    alpha: float = 3.0
    beta: float = 0.3
    l1: float = 0.2
    l2: float = 0.01
    epochs: int = 4


def _grams_of_word(word: bytes, prefixes: Sequence[int]) -> tuple[int, ...]:
    """The hash of a word and of its first letters, as far as it is longer."""
    letters = word.decode("utf-8", "replace")
    starts = [b"\x01" + letters[:n].encode() for n in prefixes if len(letters) > n]
    return tuple(word_hash(w) for w in [word, *starts])


class Features:
    """Texts to sparse vectors: sorted distinct buckets, all of one value.

    ``orders`` are the lengths of the word n-grams; ``prefixes`` adds the first letters of
    each word, for endings that vary. The value is the number of buckets to the power of
    minus ``damping``: 0 for yes or no, 0.5 for vectors of length 1.
    """

    def __init__(
        self,
        orders: Sequence[int] = (1, 2),
        prefixes: Sequence[int] = (),
        bits: int = BITS,
        lower: bool = False,
        damping: float = 0.5,
    ):
        self.orders, self.prefixes, self.bits = tuple(orders), tuple(prefixes), bits
        self.lower, self.damping = lower, damping
        self._cache = hash_cache()
        self._starts = Cached(lambda word: _grams_of_word(word, self.prefixes), 1 << 17)

    def of(self, text: bytes | None) -> tuple[np.ndarray, float]:
        text = text or b""
        words = _WORD.findall(text.lower() if self.lower else text)
        if not words:
            return np.zeros(0, dtype=np.int32), 0.0
        if self.prefixes:
            found: set[int] = set()
            for starts in map(self._starts.__getitem__, set(words)):
                found.update(starts)
            grams = [np.fromiter(found, dtype=np.uint64, count=len(found))]
            orders = [order for order in self.orders if order > 1]
        else:
            grams, orders = [], self.orders
        if orders:
            hashes = hashed(words, self._cache)
            grams += [following(hashes, order) for order in orders]
            # A word after itself is one feature, whatever the word.
            if 2 in orders and (hashes[1:] == hashes[:-1]).any():
                grams.append(following(np.array([word_hash(_SAME)], dtype=np.uint64), 1))
        buckets = np.unique(np.concatenate(grams) >> np.uint64(64 - self.bits)).astype(np.int32)
        return buckets, float(len(buckets)) ** -self.damping


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-min(max(x, -35.0), 35.0)))


def learn(
    rows: Sequence[tuple[np.ndarray, float, np.ndarray]],
    labels: np.ndarray,
    weights: np.ndarray,
    size: int,
    settings: Ftrl,
) -> np.ndarray:
    """Weights after some passes over the rows. A row is (buckets, value, dense extra inputs).

    The vector has ``size`` hashed coordinates, then one per extra input, then the intercept.
    """
    extras = len(rows[0][2]) if rows else 0
    z = np.zeros(size + extras + 1)
    n = np.zeros(size + extras + 1)
    tail = np.arange(size, size + extras + 1)
    one = np.ones(1)

    def weight(z_at: np.ndarray, n_at: np.ndarray, penalty: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z_at) * np.maximum(np.abs(z_at) - penalty, 0.0)
        return -shrunk / ((settings.beta + np.sqrt(n_at)) / settings.alpha + settings.l2)

    for _ in range(settings.epochs):
        for (buckets, value, extra), y, c in zip(rows, labels, weights):
            at = np.concatenate([buckets, tail])
            x = np.concatenate([np.full(len(buckets), value), extra, one])
            penalty = np.full(len(at), settings.l1)
            penalty[len(buckets) :] = 0.0
            z_at, n_at = z[at], n[at]
            w = weight(z_at, n_at, penalty)
            g = c * (_sigmoid(float(w @ x)) - y) * x
            grown = n_at + g * g
            z[at] = z_at + g - (np.sqrt(grown) - np.sqrt(n_at)) / settings.alpha * w
            n[at] = grown
    everywhere = np.arange(size + extras + 1)
    return weight(z, n, np.where(everywhere < size, settings.l1, 0.0))


def balanced_weights(labels: np.ndarray) -> np.ndarray:
    """Weights under which both classes count as much."""
    ones = labels.sum()
    if ones in (0, len(labels)):
        return np.ones(len(labels))
    return np.where(labels == 1, len(labels) / (2 * ones), len(labels) / (2 * (len(labels) - ones)))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, rows: int, id_column: str, text_column: str, salt: str
) -> DataFrame:
    """``doc_id, text`` and the other columns of ``labels`` for about ``rows`` labelled documents at most.

    ``labels`` has ``id`` (not null, once each). The labels drawn are broadcast: their number is bounded.
    """
    share = F.lit(float(rows)) / F.greatest(labels.agg(F.count(F.lit(1))).scalar(), F.lit(1))
    draw = F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = F.broadcast(labels.filter(draw < share))
    slim = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    # Repeated rows of one id would be learned more often than others: that with the smallest hash is taken.
    found = slim.join(drawn, slim["doc_id"] == drawn["id"]).drop("id")
    text = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    others = [F.first(quoted(c)).alias(c) for c in labels.columns if c != "id"]
    return found.groupBy("doc_id").agg(text, *others)


def learner_of(id_column: str = "doc_id", learners: int = LEARNERS):
    """Which learner a row goes to, by its id."""
    return F.pmod(F.xxhash64(F.col(id_column), F.lit("learner")), F.lit(learners)).cast("int")


def fit(sample: DataFrame, features: dict, settings: Ftrl) -> np.ndarray:
    """The averaged weights of all learners over ``doc_id, text, label``; all 0 for an empty sample."""
    size = 1 << features.get("bits", BITS)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features(**features)
        for batch in batches:
            found = [make.of(t.as_py()) for t in batch.column(1).cast(pa.binary())]
            buckets = pa.array([b for b, _ in found], pa.list_(pa.int32()))
            values = pa.array([v for _, v in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), buckets, values, batch.column(2)], names)

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        # Hashed order: the same on every run, and without runs of one class.
        rows = rows.iloc[rows["doc_id"].map(lambda i: hashlib.md5(str(i).encode()).digest()).argsort()]
        none = np.zeros(0)
        inputs = [(np.asarray(b, dtype=np.int32), v, none) for b, v in zip(rows["buckets"], rows["value"])]
        labels = rows["label"].to_numpy(dtype=float)
        w = learn(inputs, labels, balanced_weights(labels), size, settings)
        at = np.flatnonzero(w)
        return pd.DataFrame({"at": at, "w": w[at], "n": len(rows)})

    # Texts become features where they are; the learner gets a few hundred numbers of each.
    names = ["doc_id", "buckets", "value", "label"]
    kind = sample.schema["doc_id"].dataType.simpleString()
    slim = sample.select("doc_id", "text", F.col("label").cast("int"))
    found = map_batches(slim, featurise, f"doc_id {kind}, buckets array<int>, value double, label int")
    sample = store(found.coalesce(SAMPLE_TASKS), "ftrl-sample")
    parts = (
        sample.withColumn("learner", learner_of())
        .groupBy("learner")
        .applyInPandas(train, "at long, w double, n long")
    )
    total = np.zeros(size + 1)
    # Not more rows than coordinates come to the driver.
    summed = parts.groupBy("at").agg(F.sum(F.col("w") * F.col("n")).alias("w"), F.max("n")).toPandas()
    total[summed["at"]] = summed["w"]
    rows = sample.agg(F.count(F.lit(1))).first()[0]
    return total / max(rows, 1)


def score_logistic(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = TRAIN_ROWS,
    features: dict | None = None,
    settings: Ftrl = Ftrl(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs``: the chance of label 1, and whether it is 0.5 or more.

    ``labels`` has the columns ``id`` and ``label`` (0 or 1). Rows with a null id or label are not learned
    from; of an id with several labels the largest counts. Classes are weighted evenly.
    A null or empty text is scored by the intercept alone. Rows with the same id are
    scored each for itself; other columns are not read. Without labels all scores are
    0.5. An empty table gives an empty table.
    """
    features = dict(features or {})
    known = labels.filter("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    sample = labelled_sample(docs, known, rows, id_column, text_column, "ftrl")
    weights = docs.sparkSession.sparkContext.broadcast(fit(sample, features, settings).astype(np.float32))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, w = Features(**features), weights.value
        for batch in batches:
            scores = []
            for text in batch.column(1).cast(pa.binary()):
                buckets, value = make.of(text.as_py())
                scores.append(round(_sigmoid(float(w[buckets].sum(dtype=np.float64)) * value + float(w[-1])), 9))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                ["doc_id", "score", "predicted"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return map_batches(
        docs.select(id_column, text_column), work, f"doc_id {kind}, score double, predicted int"
    )
