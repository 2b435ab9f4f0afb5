"""How a forest ranks calls when one of their features comes from another call.

A forest sees of a feature only between which of its thresholds it lies, so values become codes, and
equal swaps of a call (and of calls alike) are scored once. Per tree, a call's path says within which codes
a feature may move without leaving it; only swaps outside go down the tree again, all of a block together.
Scores are sums of whole numbers, so that no order of summation makes or breaks a tie.

The areas are exact: scores go in ranges to tasks, which count the won pairs of their range.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringwatch.session import checkpoint_root, send_package, store

# Leaf shares are rounded to this; sums of a thousand trees stay below 2 ** 63.
_UNIT = 1 << 52
# Different calls that go down the trees together, and rows of a block.
_CALLS = 1 << 11
_ROWS = 1 << 15
#: Scores of one feature and repeat that go to one task: some 17 MB.
RANGE_ROWS = 1 << 20
# Marks the score of the calls as they are.
BASE = -1


@dataclass
class Tree:
    """Nodes of a tree: the feature and the last code that go left, the left child (the right one follows); leaves lead to themselves."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    share: np.ndarray

    def reached(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of each row of ``codes``."""
        n, width = codes.shape
        flat, out = codes.ravel(), np.zeros(n, np.int32)
        rows, start, node = None, np.arange(n) * width, out.copy()
        step = 0
        while len(node):
            feature = self.feature[node]
            node = self.left[node] + (flat[start + feature] > self.cut[node])
            step += 1
            if step % 3 == 0:
                going = self.left[node] != node
                done = ~going
                if rows is None:
                    rows = np.arange(n)
                out[rows[done]] = node[done]
                rows, start, node = rows[going], start[going], node[going]
        return out

    def path(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The leaf of each row, and the least and largest code of each feature that leave it there."""
        n, width = codes.shape
        flat = codes.ravel()
        low, high = np.zeros(n * width, codes.dtype), np.full(n * width, np.iinfo(codes.dtype).max, codes.dtype)
        out, rows, node = np.zeros(n, np.int32), np.arange(n), np.zeros(n, np.int32)
        while len(rows):
            going = self.left[node] != node
            out[rows[~going]] = node[~going]
            rows, node = rows[going], node[going]
            at, cut = rows * width + self.feature[node], self.cut[node]
            right = flat[at] > cut
            up, down = at[right], at[~right]
            low[up] = np.maximum(low[up], cut[right] + 1)
            high[down] = np.minimum(high[down], cut[~right])
            node = self.left[node] + right
        return out, low, high


def trees_of(df: DataFrame, model: RandomForestClassificationModel) -> tuple[list[Tree], list[np.ndarray]]:
    """The trees of a model of two classes and continuous features, and the thresholds of each feature."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/forest-read-{uuid.uuid4().hex}"
    model.write().save(path)
    node = F.col("nodeData")
    stats = node["impurityStats"]
    nodes = (
        spark.read.parquet(f"{path}/data")
        .select(
            F.col("treeID").alias("tree"),
            node["id"].alias("id"),
            node["leftChild"].alias("left"),
            node["rightChild"].alias("right"),
            node["split"]["featureIndex"].alias("feature"),
            F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
            F.coalesce(F.try_divide(stats[1], stats[0] + stats[1]), F.lit(0.0)).alias("share"),
        )
        .toArrow()
    )
    columns = {c: nodes.column(c).to_numpy() for c in nodes.column_names}
    order = np.lexsort((columns["id"], columns["tree"]))
    columns = {c: v[order] for c, v in columns.items()}
    inner = columns["left"] >= 0
    thresholds = [
        np.unique(columns["threshold"][inner & (columns["feature"] == f)]) for f in range(model.numFeatures)
    ]
    code = np.uint8 if max(map(len, thresholds)) < 255 else np.uint16
    cut = np.zeros(len(inner), code)
    for f, values in enumerate(thresholds):
        mine = inner & (columns["feature"] == f)
        cut[mine] = np.searchsorted(values, columns["threshold"][mine])
    cut[~inner] = np.iinfo(code).max
    trees = []
    for rows in np.split(np.arange(len(inner)), np.flatnonzero(np.diff(columns["tree"])) + 1):
        # Children in the order in which their parents come, so that a right child follows its sister.
        left, right, number = columns["left"][rows], columns["right"][rows], np.zeros(len(rows), np.int64)
        parents = np.flatnonzero(left >= 0)
        number[left[parents]] = 1 + 2 * np.arange(len(parents))
        number[right[parents]] = 2 + 2 * np.arange(len(parents))
        placed = np.argsort(number)
        led = np.where(left >= 0, number[left], number)
        trees.append(
            Tree(
                np.maximum(columns["feature"][rows], 0).astype(np.int16)[placed],
                cut[rows][placed],
                led.astype(np.int32)[placed],
                np.rint(columns["share"][rows] * _UNIT).astype(np.int64)[placed],
            )
        )
    return trees, thresholds


def coded(rows: DataFrame, columns: list[str], thresholds: list[np.ndarray], keep: list[str]) -> DataFrame:
    """``keep`` and ``codes``: between which thresholds the numeric ``columns`` (no nulls) lie, a few bytes per row."""
    code = np.uint8 if max(map(len, thresholds)) < 255 else np.uint16
    slim = rows.select(*keep, *[F.col(c).cast("double").alias(f"__{k}") for k, c in enumerate(columns)])
    schema = slim.select(*keep, F.lit(b"").alias("codes")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [batch.column(len(keep) + k).to_numpy(zero_copy_only=False) for k in range(len(columns))]
            found = np.stack([np.searchsorted(t, v, "left") for t, v in zip(thresholds, values)], axis=1).astype(code)
            packed = pa.array([r.tobytes() for r in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(len(keep))], packed], [*keep, "codes"])

    send_package(rows.sparkSession)
    return slim.mapInArrow(work, schema)


def swap_scores(codes: np.ndarray, call: np.ndarray, feature: np.ndarray, value: np.ndarray, trees: list[Tree]) -> tuple[np.ndarray, np.ndarray]:
    """Scores of the calls with ``codes``, and of a ``call`` each with the ``value`` in the place of its ``feature``."""
    base, moved = np.zeros(len(codes), np.int64), np.zeros(len(call), np.int64)
    at = call * codes.shape[1] + feature
    for tree in trees:
        leaf, low, high = tree.path(codes)
        share = tree.share[leaf]
        base += share
        out = np.flatnonzero((value < low[at]) | (value > high[at]))
        if len(out):
            other = codes[call[out]]
            other[np.arange(len(out)), feature[out]] = value[out]
            moved[out] += tree.share[tree.reached(other)] - share[call[out]]
    return base, moved + base[call]


def _packed(score: np.ndarray, fraud: np.ndarray) -> bytes:
    """Different scores in order, with how many frauds and other calls have each."""
    values, place = np.unique(score, return_inverse=True)
    ones = np.bincount(place, fraud, len(values)).astype(np.int64)
    counts = np.stack([ones, np.bincount(place, minlength=len(values)) - ones]).astype(np.int32)
    return values.tobytes() + counts.tobytes()


def _won(blobs: list[bytes]) -> tuple[float, int, int]:
    """Pairs in which the fraud scores higher, ties as a half, and the numbers of frauds and other calls."""
    score = np.concatenate([np.frombuffer(b, np.int64, len(b) // 16) for b in blobs])
    counts = np.concatenate([np.frombuffer(b, np.int32, offset=len(b) // 2).reshape(2, -1) for b in blobs], axis=1)
    order = np.argsort(score, kind="stable")
    score, counts = score[order], counts[:, order].astype(np.int64)
    first = np.flatnonzero(np.diff(score, prepend=score[0] - 1))
    ones, zeros = np.add.reduceat(counts[0], first), np.add.reduceat(counts[1], first)
    below = np.cumsum(zeros) - zeros
    return float((ones * (2 * below + zeros)).sum()) / 2, int(ones.sum()), int(zeros.sum())


def areas(calls: DataFrame, pairs: DataFrame, trees: list[Tree], features: int, rows: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``feature, repeat, roc_auc``: the area with each feature (by number) swapped, and that of ``calls`` as they are under ``BASE``.

    ``calls`` has ``is_fraud, codes``, ``pairs`` also ``repeat`` and the ``donor``'s codes; ``rows`` is how
    many calls there are. A score range of one feature and repeat goes to one task; equal scores are
    counted together before.
    """
    spark = calls.sparkSession
    send_package(spark)
    sent = spark.sparkContext.broadcast(trees)
    code = trees[0].cut.dtype

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        """Labels and repeats as they are, codes as tables, by blocks of many rows."""

        def block(held: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
            table = pa.Table.from_batches(held)
            return tuple(
                np.frombuffer(b"".join(c.to_pylist()), code).reshape(-1, features) if c.type == pa.binary() else c.to_numpy()
                for c in table.columns
            )

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= _ROWS:
                yield block(held)
                held, n = [], 0
        if n:
            yield block(held)

    def distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = np.ascontiguousarray(codes).view(np.dtype((np.void, codes.shape[1] * code.itemsize))).ravel()
        _, first, place = np.unique(keys, return_index=True, return_inverse=True)
        return codes[first], place

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(0, np.int64)
        for fraud, codes in blocks(batches):
            calls_, place = distinct(codes)
            base, _ = swap_scores(calls_, nothing, nothing, nothing.astype(code), sent.value)
            yield pa.RecordBatch.from_arrays([pa.array(base[place]), pa.array(fraud)], ["score", "is_fraud"])

    scored = store(calls.select("is_fraud", "codes").mapInArrow(plain, "score long, is_fraud int"), "forest-scores")
    n_ranges = math.ceil(max(rows, 1) / range_rows)
    ends = np.array(scored.approxQuantile("score", [k / n_ranges for k in range(1, n_ranges)], 1e-3) if rows and n_ranges > 1 else [])

    def sorted_out(feature: int, repeat: int, score: np.ndarray, fraud: np.ndarray) -> list[tuple]:
        part = np.searchsorted(ends, score.astype(float), "left")
        return [(feature, repeat, int(p), _packed(score[part == p], fraud[part == p])) for p in np.unique(part)]

    def emitted(found: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

    def as_they_are(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield emitted(sorted_out(BASE, 0, *(batch.column(k).to_numpy() for k in (0, 1))))

    def swapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fraud, codes, repeat, donor in blocks(batches):
            calls_, place = distinct(codes)
            # Different (call, feature, value), one number each.
            key = (place[:, None] * features + np.arange(features)) * (np.iinfo(code).max + 1) + donor
            known, which = np.unique(key.ravel(), return_inverse=True)
            where, value = np.divmod(known, np.iinfo(code).max + 1)
            call, feature = np.divmod(where, features)
            score = np.zeros(len(known), np.int64)
            for start in range(0, len(calls_), _CALLS):
                lo, hi = np.searchsorted(call, [start, start + _CALLS])
                some = calls_[start : start + _CALLS]
                _, score[lo:hi] = swap_scores(some, call[lo:hi] - start, feature[lo:hi], value[lo:hi].astype(code), sent.value)
            score = score[which.reshape(key.shape)]
            found = []
            for r in np.unique(repeat):
                mine = repeat == r
                for f in range(features):
                    found += sorted_out(f, int(r), score[mine, f], fraud[mine])
            yield emitted(found)

    def count(group: pa.Table) -> pa.Table:
        won, ones, zeros = _won(group.column("scores").to_pylist())
        keys = {c: group.column(c)[:1] for c in ("feature", "repeat", "part")}
        return pa.table({**keys, "won": pa.array([won]), "ones": pa.array([ones]), "zeros": pa.array([zeros])})

    names = ["feature", "repeat", "part", "scores"]
    schema = "feature int, repeat int, part int, scores binary"
    blobs = scored.mapInArrow(as_they_are, schema).unionByName(
        pairs.select("is_fraud", "codes", "repeat", "donor").mapInArrow(swapped, schema)
    )
    parts = blobs.groupBy("feature", "repeat", "part").applyInArrow(
        count, "feature int, repeat int, part int, won double, ones long, zeros long"
    )
    lower = W.partitionBy("feature", "repeat").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    placed = store(parts, "swapped-areas").withColumn("below", F.coalesce(F.sum("zeros").over(lower), F.lit(0)))
    wins = F.sum(F.col("won") + F.col("ones").cast("double") * F.col("below"))
    pairs_of = F.sum("ones").cast("double") * F.sum("zeros").cast("double")
    return placed.groupBy("feature", "repeat").agg(F.try_divide(wins, pairs_of).alias("roc_auc"))
