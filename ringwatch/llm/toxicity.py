"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models on hashed words and
word beginnings. The model of a category has the probabilities of all earlier
categories as further inputs. It is trained with out-of-fold probabilities, each
predicted by a model that has not seen the row, so that it learns how far it can trust
them on new documents.

Learning uses a bounded sample of the labelled rows (``rows``), reduced to its feature
numbers. Each group of a step trains one model on it: one per fold, one on all rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.ftrl import BITS, SAMPLE_TASKS, Features, Ftrl, _sigmoid, balanced_weights, labelled_sample, learn
from ringwatch.llm.tasks import map_batches
from ringwatch.session import send_package, store

#: Labelled rows that are learned from at most (a few more by chance of the hash).
TRAIN_ROWS = 16_000
FOLDS = 4
ALL_ROWS = -1
#: Words and their beginnings, in lower case, each yes or no.
FEATURES = {"orders": (1,), "prefixes": (4, 5, 6), "lower": True, "damping": 0.0, "bits": BITS}
SETTINGS = Ftrl(alpha=1.0, beta=1.0, l1=8.0, l2=0.1, epochs=4)


def _featurised(sample: DataFrame, categories: Sequence[str]) -> DataFrame:
    """``doc_id``, the labels and ``buckets``, with the fold of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features(**FEATURES)
        for batch in batches:
            found = [make.of(t.as_py())[0] for t in batch.column(1).cast(pa.binary())]
            columns = [batch.column(0), *[batch.column(2 + k) for k in range(len(categories))]]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.list_(pa.int32()))], ["doc_id", *categories, "buckets"]
            )

    kind = sample.schema["doc_id"].dataType.simpleString()
    labels = ", ".join(f"`{c}` int" for c in categories)
    rows = map_batches(
        sample.select("doc_id", "text", *[F.col(f"`{c}`").cast("int") for c in categories]),
        work,
        f"doc_id {kind}, {labels}, buckets array<int>",
    )
    return rows.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int"))


def _step(rows: DataFrame, category: str, earlier: Sequence[str], out_of_fold: bool) -> DataFrame:
    """Train one category: ``at, w`` of the model on all rows, ``doc_id, p`` of each row out of its fold."""
    size = 1 << FEATURES["bits"]

    def train(group: pd.DataFrame) -> pd.DataFrame:
        held = int(group["held"].iloc[0])
        group = group.iloc[group["doc_id"].map(lambda i: hashlib.md5(str(i).encode()).digest()).argsort()]
        extra = group[list(earlier)].to_numpy(dtype=float)
        inputs = [
            (np.asarray(b, dtype=np.int32), float(max(len(b), 1)) ** -FEATURES["damping"], x)
            for b, x in zip(group["buckets"], extra)
        ]
        labels = group[category].to_numpy(dtype=float)
        mine = np.flatnonzero(group["fold"].to_numpy() != held)
        used = labels[mine]
        w = learn([inputs[k] for k in mine], used, balanced_weights(used), size, SETTINGS) if len(mine) else None
        if w is None:
            w = np.zeros(size + len(earlier) + 1)
        if held == ALL_ROWS:
            at = np.flatnonzero(w)
            return pd.DataFrame({"at": at, "w": w[at], "doc_id": None, "p": np.nan})
        rest = np.flatnonzero(group["fold"].to_numpy() == held)
        p = [_sigmoid(float(w[b].sum()) * v + float(w[size:-1] @ x) + float(w[-1])) for b, v, x in (inputs[k] for k in rest)]
        return pd.DataFrame({"at": -1, "w": np.nan, "doc_id": group["doc_id"].to_numpy()[rest], "p": p})

    folds = [ALL_ROWS, *range(FOLDS)] if out_of_fold else [ALL_ROWS]
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (
        rows.withColumn("held", F.explode(F.array(*[F.lit(f) for f in folds])))
        .groupBy("held")
        .applyInPandas(train, f"at long, w double, doc_id {kind}, p double")
    )


def fit_chain(sample: DataFrame, categories: Sequence[str]) -> list[np.ndarray]:
    """The weights of each category's model, in order: hashed features, earlier categories, intercept."""
    send_package(sample.sparkSession)
    size = 1 << FEATURES["bits"]
    rows = store(_featurised(sample, categories).coalesce(SAMPLE_TASKS), "chain-sample")
    models: list[np.ndarray] = []
    earlier: list[str] = []
    for k, category in enumerate(categories):
        last = k == len(categories) - 1
        step = _step(rows, category, earlier, out_of_fold=not last)
        if not last:
            step = store(step, "chain-step")
        weights = np.zeros(size + len(earlier) + 1)
        found = step.filter("at >= 0").select("at", "w").toPandas()  # not more than one row per weight
        weights[found["at"]] = found["w"]
        models.append(weights)
        if not last:
            name = f"__p{k}"
            predicted = step.filter("at < 0").select("doc_id", F.col("p").alias(name))
            rows = store(rows.join(predicted, "doc_id").coalesce(SAMPLE_TASKS), "chain-sample")
            earlier.append(name)
    return models


def chain_probabilities(models: Sequence[np.ndarray], buckets: np.ndarray, value: float) -> list[float]:
    """The probability of each category of one document, in the order of the chain."""
    size = 1 << FEATURES["bits"]
    found: list[float] = []
    for w in models:
        x = float(w[buckets].sum(dtype=np.float64)) * value + float(w[-1])
        x += float(np.dot(w[size:-1], found)) if found else 0.0
        found.append(round(_sigmoid(x), 9))
    return found


def score_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    rows: int = TRAIN_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id`` and for each category ``p_<category>``, for every row of ``docs``; then score and predicted of the last.

    ``labels`` has the column ``id`` and one of 0 and 1 per category; rows with a null in
    any of them are not learned from, and of an id with several rows the largest label
    counts. A null or empty text has no features and gets the intercepts. Rows with the same id
    are scored each for itself; other columns are not read. Without labels all
    probabilities are 0.5. An empty table gives an empty table.
    """
    categories = list(categories)
    known = (
        labels.select("id", *categories)
        .dropna()
        .groupBy("id")
        .agg(*[F.max(c).alias(c) for c in categories])
    )
    sample = labelled_sample(docs, known, rows, id_column, text_column, "chain")
    fitted = [m.astype(np.float32) for m in fit_chain(sample, categories)]
    models = docs.sparkSession.sparkContext.broadcast(fitted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features(**FEATURES)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = [chain_probabilities(models.value, *make.of(t.as_py())) for t in texts]
            each = list(zip(*found)) if found else [[]] * len(categories)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(list(p), pa.float64()) for p in each],
                    pa.array(list(each[-1]), pa.float64()),
                    pa.array([int(p >= 0.5) for p in each[-1]], pa.int32()),
                ],
                ["doc_id", *[f"p_{c}" for c in categories], "score", "predicted"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    parts = "".join(f"`p_{c}` double, " for c in categories)
    return map_batches(
        docs.select(id_column, text_column), work, f"doc_id {kind}, {parts}score double, predicted int"
    )
