"""Embedding near-duplicates against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import ringwatch.llm.embedding_dups as dups
from llm_cases import components
from ringwatch.llm.hnsw import Hnsw

SCHEMA = "vec_id long, embedding array<float>, label int, linked int"


def clustered(seed, n=300, dim=16, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, n // 20), dim))
    return (centres[rng.integers(0, len(centres), n)] + spread * rng.normal(size=(n, dim))).astype(np.float32)


def plain(rows, threshold=0.98):
    good = [
        (i, np.array(v, dtype=float), label)
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = [
        (a, b) for k, (a, x, s) in enumerate(good) for b, y, t in good[:k]
        if s == t and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold
    ]
    count = {}
    for pair in links:
        for i in pair:
            count[i] = count.get(i, 0) + 1
    ids = {i for i, _, _ in rows if i is not None}
    found = components(ids, links)
    return sorted(((i, count.get(i, 0), found.get(i), i == found.get(i)) for i, _, _ in rows), key=repr)


def got(spark, rows):
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in dups.embedding_groups(df).collect()), key=repr)


@pytest.mark.parametrize("shard_rows", [8192, 64])
def test_same_as_all_pairs(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(dups, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(dups, "CHUNK_ROWS", 50)
    vectors = clustered(1)
    rows = [(k, v.tolist(), int(k % 3 == 0)) for k, v in enumerate(vectors)]
    rows += [(1000 + k, vectors[5].tolist(), 0) for k in range(40)]  # copies
    rows += [(2000 + k, (3 * vectors[7]).tolist(), 0) for k in range(5)]  # the same direction
    assert got(spark, rows) == plain(rows)


def test_shards_are_searched_by_their_graphs(spark, monkeypatch):
    monkeypatch.setattr(dups, "SHARD_ROWS", 128)
    monkeypatch.setattr(dups, "CHUNK_ROWS", 100)
    rng = np.random.default_rng(9)
    base = rng.normal(size=(380, 24))
    vectors = np.concatenate([base, base[:20] + 0.01 * rng.normal(size=(20, 24))]).astype(np.float32)
    rows = [(k, v.tolist(), 1) for k, v in enumerate(vectors)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    classes = df.selectExpr("vec_id", "label", "size(embedding) as dim", "embedding as vector", "1L as copies", "4 as n_shards", "2 as n_chunks").withColumn(
        "shard", dups._deal("vec_id", "shard", F.lit(4))
    )
    graphs = dups.build_shards(classes, 0.98).collect()
    assert len(graphs) == 4 and all(0 < r["beam"] and r["recall"] >= dups.AUDIT_RECALL for r in graphs)
    assert got(spark, rows) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 3.0], 1),
        (8, [1.0, nan, 3.0], 1), (9, [1.0, inf, 3.0], 1), (10, [], 1), (11, [1.0, 2.0], 1), (12, [2e38, 2e38, 2e38], 1),
        (13, [1e-38, 1e-38, 1e-38], 1), (None, v, 1), (14, [-1.0, -2.0, -3.0], 1),
    ]
    assert got(spark, rows) == plain(rows)


def test_repeated_ids(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1)]
    assert got(spark, rows) == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]


def test_empty_table(spark):
    assert got(spark, []) == []


def test_graph_finds_neighbours_and_survives_bytes():
    units = dups._unit(clustered(3, 800, 32, 0.02).astype(float))
    graph = Hnsw.from_bytes(Hnsw(units, range(len(units))).to_bytes())
    truth = [set(np.flatnonzero(units @ u >= 0.98).tolist()) for u in units]
    beam, recall = dups.audited_beam(graph, units, 0.98)
    assert recall >= dups.AUDIT_RECALL
    met = sum(len(t & set(graph.within(u, 0.98 - 1e-5, beam))) for t, u in zip(truth, graph.vectors))
    assert met >= 0.9 * sum(map(len, truth))


def test_a_shard_whose_audit_never_passes_is_scanned(spark, monkeypatch):
    monkeypatch.setattr(Hnsw, "within", lambda self, query, radius, beam: [])
    units = dups._unit(clustered(3, 30).astype(float))
    assert dups.audited_beam(Hnsw(units, range(30)), units, 0.98) == (0, 1.0)
