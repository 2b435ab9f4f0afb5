"""The steps of a grid search around the fits: stratified folds, the refit of the best point and its measures."""

import pytest

from ringwatch.operators import evaluate, models
from ringwatch.plans import catalog


def test_grid_search_refits_and_measures_the_best_point(spark, folder, data, monkeypatch):
    real = models.cross_validate
    small = {"iterations": (2, 4), "steps": (0.1,), "depths": (2,)}
    monkeypatch.setattr(models, "cross_validate", lambda train, features, name: real(train, features, name=name, **small))
    rows = catalog.queries()["grid_search"](spark, folder).collect()
    assert [r["best"] for r in rows] == [True, False]
    fitted = models.fit_boosting(data.train, data.features, rows[0]["iterations"], 0.1, 2)
    known = models.scored_metrics(fitted.score(data.test), fitted.name).first()
    assert {m: rows[0][f"test_{m}"] for m in evaluate.METRICS} == pytest.approx({m: known[m] for m in evaluate.METRICS})
    assert rows[1]["test_roc_auc"] is None


def test_folds_have_the_same_share_of_each_class(spark, data, monkeypatch):
    seen = []
    real = models.boosting_grid.cross_validated_areas
    monkeypatch.setattr(models.boosting_grid, "cross_validated_areas", lambda calls, *rest: seen.append(calls) or real(calls, *rest))
    models.cross_validate(data.train, data.features, iterations=(1,), steps=(0.1,), depths=(1,))
    n = {(r["is_fraud"], r["fold"]): r["count"] for r in seen[0].groupBy("is_fraud", "fold").count().collect()}
    assert len(n) == 6 and all(max(n[c, f] for f in range(3)) - min(n[c, f] for f in range(3)) <= 1 for c in (0, 1))
    odd = spark.createDataFrame([(None, 1)] * 4 + [("a", 0)] * 5 + [("b", 0)], "call_id string, is_fraud int")
    folds = [(r["is_fraud"], r["fold"]) for r in models.stratified_folds(odd, 2).collect()]
    assert sorted(folds) == [(0, 0)] * 3 + [(0, 1)] * 3 + [(1, 0)] * 2 + [(1, 1)] * 2
