"""Quality scores and the toxicity chain on held-out labels, and their edge cases."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from llm_cases import no_rows, odd_rows
from ringwatch.llm.ftrl import Features, Ftrl, balanced_weights, learn, score_logistic
from ringwatch.llm.toxicity import score_chain

FOLDER = "/root/testdata/sf0.01"


def accuracy(rows, truth):
    pairs = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["doc_id"] in truth]
    ones = np.mean([p for p, t in pairs if t == 1])
    zeros = 1 - np.mean([p for p, t in pairs if t == 0])
    return ones, zeros


def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    held = {r["id"]: r["label"] for r in labels.collect() if zlib.crc32(str(r["id"]).encode()) % 3 == 1}
    rows = score_logistic(docs, labels.filter(F.crc32(F.col("id").cast("string")) % 3 != 1)).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    good, bad = accuracy(rows, held)
    assert good > 0.9 and bad > 0.7


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select(
        F.col("doc_id").alias("id"), (1 - F.col("quality")).alias("low_quality"), "toxic"
    )
    held = {r["id"]: r["toxic"] for r in labels.collect() if r["id"] % 4 == 0}
    scored = score_chain(docs, labels.filter("id % 4 != 0"), ["low_quality", "toxic"])
    assert scored.columns == ["doc_id", "p_low_quality", "p_toxic", "score", "predicted"]
    toxic, clean = accuracy(scored.collect(), held)
    assert toxic > 0.6 and clean > 0.98


def test_scores_do_not_depend_on_the_layout(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("doc_id < 200")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    one = {tuple(r) for r in score_logistic(docs.repartition(5), labels).collect()}
    assert one == {tuple(r) for r in score_logistic(docs.coalesce(1), labels.repartition(3)).collect()}


def test_repeated_ids_do_not_depend_on_the_layout(spark):
    rows = [(k // 2, f"{'good' if k // 2 % 2 else 'bad'} w{k} w{k % 5}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)], "id long, label int")
    chain = labels.selectExpr("id", "1 - label as bad", "label as toxic")
    scores, chained = set(), set()
    for n in (1, 2, 5):
        scores.add(frozenset(map(tuple, score_logistic(docs.repartition(n), labels).collect())))
        chained.add(frozenset(map(tuple, score_chain(docs.repartition(n), chain, ["bad", "toxic"]).collect())))
    assert len(scores) == len(chained) == 1


def plain_ftrl(rows, labels, weights, size, settings):
    """The same updates with dictionaries, coordinate by coordinate."""
    z, n = {}, {}
    extras = len(rows[0][2])

    def weight(i):
        penalty = settings.l1 if i < size else 0.0
        a = z.get(i, 0.0)
        if abs(a) <= penalty:
            return 0.0
        return -(a - penalty * (1 if a > 0 else -1)) / ((settings.beta + n.get(i, 0.0) ** 0.5) / settings.alpha + settings.l2)

    for _ in range(settings.epochs):
        for (buckets, value, extra), y, c in zip(rows, labels, weights):
            x = {int(b): value for b in buckets} | {size + k: e for k, e in enumerate(extra)} | {size + extras: 1.0}
            w = {i: weight(i) for i in x}
            g = c * (1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items()))) - y)
            for i, v in x.items():
                step, had = g * v, n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + step - ((had + step * step) ** 0.5 - had**0.5) / settings.alpha * w[i]
                n[i] = had + step * step
    return [weight(i) for i in range(size + extras + 1)]


def test_learning_equals_plain_updates():
    rng = np.random.default_rng(3)
    rows = [(np.unique(rng.integers(0, 32, 6)).astype(np.int32), 0.5, rng.normal(size=2)) for _ in range(80)]
    labels = np.array([float(r[0][0] < 4 or r[2][0] > 0.5) for r in rows])
    settings = Ftrl(alpha=0.7, beta=1.0, l1=0.3, l2=0.1, epochs=3)
    weights = balanced_weights(labels)
    assert np.allclose(learn(rows, labels, weights, 32, settings), plain_ftrl(rows, labels, weights, 32, settings), atol=1e-9)


def test_learning_uses_later_inputs():
    rng = np.random.default_rng(0)
    extra = rng.integers(0, 2, 300)
    rows = [(np.array([k % 7], dtype=np.int32), 1.0, np.array([float(x)])) for k, x in enumerate(extra)]
    w = learn(rows, extra.astype(float), balanced_weights(extra), 8, Ftrl(alpha=1.0))
    assert w[8] > 1 and w[8] + w[9] > 0 > w[9]
    assert not learn([], np.zeros(0), np.zeros(0), 8, Ftrl()).any()


def test_features():
    make = Features(orders=(1, 2), bits=12)
    assert len(make.of(None)[0]) == len(make.of(b" \n")[0]) == 0
    buckets, value = make.of(b"a b")
    assert len(buckets) == 3 and value == len(buckets) ** -0.5
    starts = Features(orders=(1,), prefixes=(4, 5), lower=True, damping=0.0)
    assert len(np.intersect1d(starts.of("Schönheit".encode())[0], starts.of("schönes".encode())[0])) == 2


def test_odd_rows(spark):
    docs = odd_rows(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (6, 1), (None, 1), (3, None)], "id long, label int")
    rows = score_logistic(docs, labels).collect()
    assert sorted(repr(r["doc_id"]) for r in rows) == sorted(repr(r["doc_id"]) for r in docs.collect())
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 3, 4)}) == 1
    chained = score_chain(docs, labels.selectExpr("id", "label as bad", "1 - label as toxic"), ["bad", "toxic"]).collect()
    assert len(chained) == len(rows)
    assert len({tuple(r)[1:] for r in chained if r["doc_id"] in (2, 3, 4)}) == 1


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], "id long, label int")
    assert {r["score"] for r in score_logistic(odd_rows(spark), nothing).collect()} == {0.5}
    assert score_logistic(no_rows(spark), nothing).count() == 0
    both = nothing.selectExpr("id", "label as bad", "label as toxic")
    assert {r["score"] for r in score_chain(odd_rows(spark), both, ["bad", "toxic"]).collect()} == {0.5}
    assert score_chain(no_rows(spark), both, ["bad", "toxic"]).count() == 0
