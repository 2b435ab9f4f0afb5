"""Permutation importance of a forest by codes and paths, against scoring every swapped call."""

import random

import numpy as np
import pytest

from ringwatch.operators import audits, models, swapped


@pytest.fixture(scope="module")
def forest_and_rows(spark):
    rng = random.Random(4)
    rows = []
    for i in range(900):
        a, b, c = rng.random(), rng.randrange(4), rng.random() < 0.3
        rows.append((f"c{i}", int(a + 0.2 * b + 0.2 * c + rng.gauss(0, 0.2) > 0.8), a if i % 9 else None, b, c))
    df = spark.createDataFrame(rows, "call_id string, is_fraud int, a double, b int, c boolean").repartition(3).cache()
    return models.fit_forest(df.filter("call_id < 'c5'"), ["a", "b", "c"], trees=12), df.filter("call_id >= 'c5'")


def table(areas):
    return {(r["feature"], r["repeat"]): (r["roc_auc"], r["base"]) for r in areas.collect()}


def test_the_same_areas_as_by_scoring_every_swapped_call(forest_and_rows, monkeypatch):
    fitted, valid = forest_and_rows
    known = table(audits._scored_areas(valid, fitted, 3, 7))
    found = table(audits._forest_areas(valid, fitted, 3, 7))
    assert len(found) == 9 and found.keys() == known.keys()
    for key, areas in found.items():
        assert areas == pytest.approx(known[key], abs=1e-9)
    # Many ranges, blocks and tasks.
    monkeypatch.setattr(swapped.areas, "__defaults__", (50,))
    monkeypatch.setattr(swapped, "_ROWS", 64)
    monkeypatch.setattr(swapped, "_CALLS", 8)
    monkeypatch.setattr(audits, "PAIRS_PER_TASK", 200)
    assert table(audits._forest_areas(valid, fitted, 3, 7)) == found


def test_no_swapped_call_is_scored_by_the_model(forest_and_rows, monkeypatch):
    fitted, valid = forest_and_rows
    monkeypatch.setattr(models.Fitted, "score", lambda *_: pytest.fail("scored row by row"))
    rows = audits.permutation_importance(valid, fitted, repeats=2).collect()
    assert [r["feature"] for r in rows][0] == "a" and len(rows) == 3


def test_scores_of_the_trees_are_those_of_the_model(forest_and_rows):
    fitted, valid = forest_and_rows
    trees, thresholds = swapped.trees_of(valid, fitted.estimator)
    rows = fitted.pipeline.transform(valid).select("forest_features", "forest_raw").collect()
    values = np.array([r["forest_features"].toArray() for r in rows])
    codes = np.stack([np.searchsorted(t, v, "left") for t, v in zip(thresholds, values.T)], axis=1).astype(np.uint8)
    none = np.zeros(0, np.int64)
    base, _ = swapped.swap_scores(codes, none, none, none.astype(np.uint8), trees)
    assert base / 2.0**52 == pytest.approx([r["forest_raw"][1] for r in rows])


def test_one_class_and_no_rows(forest_and_rows):
    fitted, valid = forest_and_rows
    assert {r["importance"] for r in audits.permutation_importance(valid.filter("is_fraud = 1"), fitted, 2).collect()} == {None}
    assert audits.permutation_importance(valid.filter("is_fraud > 1"), fitted, 2).count() == 0
