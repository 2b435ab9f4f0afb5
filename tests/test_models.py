import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ringwatch.operators import audits, evaluate, models, ordered
from ringwatch.operators import features as feat
from ringwatch.plans import train
from ringwatch.streaming import scoring


def test_metrics_without_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "is_fraud int, prediction int")
    assert tuple(evaluate.classification_metrics(df).first()) == (0.5, 0.0, 0.0, 0.0)
    assert [r["n"] for r in evaluate.confusion_matrix(df).collect()] == [1, 0, 1, 0]
    report = {r["class"]: r for r in evaluate.class_report(df).collect()}
    assert report["0"]["recall"] == 1.0 and report["1"]["f1"] == 0.0
    assert report["macro avg"]["precision"] == 0.25 and report["weighted avg"]["support"] == 2


def pairwise(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_equals_pair_counting(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randrange(2), round(rng.random(), rng.choice([1, 6]))) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, is_fraud int, score double").repartition(4)
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(pairwise([r[1:] for r in rows]))
    for r in evaluate.roc_auc(df, by=["g"]).collect():
        assert r["roc_auc"] == pytest.approx(pairwise([x[1:] for x in rows if x[0] == r["g"]]))


def test_auc_of_equal_scores_and_of_one_class(spark):
    df = spark.createDataFrame([(1, 0.2), (0, 0.2), (0, 0.2)], "is_fraud int, score double")
    assert evaluate.roc_auc(df).first()[0] == 0.5
    assert evaluate.roc_auc(df.filter("is_fraud = 0")).first()[0] is None


@pytest.fixture(scope="module")
def fitted(data):
    return train.fit_all(data, train.Sizes(logistic_iterations=50, trees=20, boosting_iterations=5))


def test_models_are_good_and_the_vote_lies_between(data, fitted):
    voted = models.soft_vote(data.test, fitted)
    names = [m.name for m in fitted]
    table = {r["model"]: r for r in models.compare_models(voted, [*names, "vote"]).collect()}
    assert all(r["roc_auc"] > 0.9 for r in table.values())
    probabilities = [F.col(f"{n}_p") for n in names]
    outside = (F.col("vote_p") > F.greatest(*probabilities) + 1e-12) | (F.col("vote_p") < F.least(*probabilities) - 1e-12)
    assert voted.filter(outside).count() == 0
    metrics = models.compare_models(voted, names)
    best = models.best_model(metrics, names)
    assert table[best]["roc_auc"] == max(table[n]["roc_auc"] for n in names)


def test_best_model_takes_the_first_on_a_tie(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.8)], "model string, roc_auc double")
    assert models.best_model(df, ["c", "b", "a"]) == "b"


def test_saved_model_scores_the_same(data, fitted, tmp_path):
    for member in fitted:
        path = str(tmp_path / member.name)
        models.save_model(member, path)
        loaded = models.load_model(path)
        assert loaded.features == member.features and loaded.name == member.name
        a, b = models.score_calls(data.test, member), models.score_calls(data.test, loaded)
        assert a.exceptAll(b).count() == 0


def test_scored_calls(data, fitted):
    scored = models.score_calls(data.test, fitted[0])
    assert scored.columns == ["call_id", "prediction", "fraud_probability", "confidence", "risk_band"]
    assert scored.filter("confidence < 0.5 or fraud_probability not between 0 and 1").count() == 0
    assert scored.filter("(prediction = 1) != (fraud_probability > 0.5)").count() == 0


def test_logistic_matches_a_reference_solution(spark):
    """Balanced weights and penalty: the gradient of the documented objective is zero."""
    rng = random.Random(4)
    rows = []
    for i in range(300):
        y = int(rng.random() < 0.3)
        rows.append((f"c{i}", y, rng.gauss(y, 1.0), rng.gauss(0, 2.0)))
    df = spark.createDataFrame(rows, "call_id string, is_fraud int, a double, b double")
    fitted = models.fit_logistic(df, ["a", "b"], scaled=False)
    w, b0 = list(fitted.estimator.coefficients), fitted.estimator.intercept
    n, n1 = len(rows), sum(r[1] for r in rows)
    gradient = list(w)
    import math

    for _, y, *x in rows:
        weight = n / (2 * (n1 if y else n - n1))
        p = 1 / (1 + math.exp(-(sum(wi * xi for wi, xi in zip(w, x)) + b0)))
        for j in range(2):
            gradient[j] += weight * (p - y) * x[j]
    assert all(abs(g) < 1e-2 for g in gradient)


def test_fill_zero_and_median_differ_only_where_null(data):
    zero = models.PipelineModel(models.fit_preparation(data.train, "m", data.features, True, "zero")).transform(data.test)
    column = "__m_time_to_next_action_min"
    assert zero.filter(F.col("time_to_next_action_min").isNull() & (F.col(column) != 0)).count() == 0
    median = models.PipelineModel(models.fit_preparation(data.train, "m", data.features, True, "median")).transform(data.test)
    both = zero.select("call_id", F.col(column).alias("z")).join(
        median.select("call_id", "time_to_next_action_min", F.col(column).alias("m")), "call_id"
    )
    assert both.filter("time_to_next_action_min is not null and z != m").count() == 0
    assert both.filter("time_to_next_action_min is null").select("m").distinct().count() == 1


def test_importances(data, fitted):
    table = models.impurity_importance(data.table, fitted[1]).collect()
    assert sum(r["importance"] for r in table) == pytest.approx(1.0)
    assert len(table) == len(data.features)
    coefficients = models.coefficient_report(data.table, fitted[0]).collect()
    assert [r["rank"] for r in coefficients] == list(range(1, 18))


def test_permutation_importance(data, fitted):
    valid = data.test
    table = {r["feature"]: r for r in audits.permutation_importance(valid, fitted[0], repeats=2).collect()}
    assert len(table) == len(data.features)
    assert table["time_to_next_action_min"]["importance"] > 0.01
    # A number prefix hardly matters.
    assert abs(table["caller_number_prefix_freq"]["importance"]) < 0.05


def test_permuted_rows_are_a_permutation(data):
    shuffled = audits._in_random_order(data.test.select("call_id"), 3, 7)
    n = data.test.count()
    rows = shuffled.groupBy("repeat").agg(
        F.count("*").alias("n"), F.countDistinct("call_id").alias("ids"), F.countDistinct("place").alias("places"),
        F.min("place").alias("low"), F.max("place").alias("high"),
    ).collect()
    assert [tuple(r)[1:] for r in rows] == [(n, n, n, 0, n - 1)] * 3
    again = audits._in_random_order(data.test.select("call_id"), 3, 7)
    assert shuffled.exceptAll(again).count() == 0


def test_label_permutation(data, fitted):
    row = audits.label_permutation(fitted[0].score(data.test), "logistic_p", repeats=20).first()
    assert row["base_auc"] > 0.9 and abs(row["shuffled_mean_auc"] - 0.5) < 0.05 and row["shuffled_std_auc"] > 0


def test_single_feature(data):
    rows = audits.single_feature_auc(data.train, data.test, data.features[:10]).collect()
    areas = {r["feature"]: r["roc_auc"] for r in rows}
    assert len(rows) == 10 and rows[0]["roc_auc"] == max(areas.values())
    assert areas["time_to_next_action_min"] > 0.7 and areas["twofa_confirmed_after_call"] > 0.7


def test_single_feature_without_signal(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 1.0)], "is_fraud int, x double")
    assert audits.single_feature_auc(df, df, ["x"]).first()["roc_auc"] == 0.5


def test_grid_search(data):
    table, best = models.grid_search(data.train, data.features, iterations=(2, 4), steps=(0.1,), depths=(2,))
    rows = table.collect()
    assert len(rows) == 2 and rows[0]["mean_roc_auc"] >= rows[1]["mean_roc_auc"] > 0.7
    assert best.estimator.getMaxIter() == rows[0]["iterations"]


def test_gradient_is_zero_at_the_optimum(data):
    fitted = models.fit_logistic(data.train, data.features)
    assert all(r["gradient"] < 1e-4 for r in models.logistic_gradient(data.train, fitted).collect())


def test_shared_facts_change_nothing(data):
    facts = models.facts_of(data.train, data.features)
    one = models.fit_logistic(data.train, data.features, max_iter=20, facts=facts)
    two = models.fit_logistic(data.train, data.features, max_iter=20)
    assert list(one.estimator.coefficients) == pytest.approx(list(two.estimator.coefficients))


def test_random_choices(spark):
    df = spark.range(500).selectExpr("cast(id as string) as call_id", "id as v")
    rows = ordered.random_choices(df, "call_id", 123, 3, 7).collect()
    sets = [{r["call_id"] for r in rows if r["repeat"] == k} for k in range(3)]
    assert [len(s) for s in sets] == [123] * 3 and len(rows) == 369 and sets[0] != sets[1]
    assert ordered.random_choices(df, "call_id", 0, 3, 7).count() == 0
    assert ordered.random_choices(df, "call_id", 500, 2, 7).count() == 1000


def test_mid_ranks(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", 5.0)], "call_id string, s double")
    got = {r["call_id"]: r["mid_rank"] for r in ordered.mid_ranks(df, "s", ["call_id"]).collect()}
    assert got == {"a": 1.0, "b": 2.5, "c": 2.5, "d": 4.0}


def test_metric_delta(spark):
    make = lambda v: spark.createDataFrame([(v,) * 5], ", ".join(f"{m} double" for m in evaluate.METRICS))
    got = evaluate.metric_delta(make(0.5), make(0.75)).collect()
    assert {r["metric"] for r in got} == set(evaluate.METRICS) and all(r["delta"] == 0.25 for r in got)


def test_stream_scores_like_a_batch(spark, raw, data, fitted, tmp_path):
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    counts = feat.prefix_counts(raw)
    stream = scoring.read_call_stream(spark, str(tmp_path / "in"), maxFilesPerTrigger=1)
    scoring.write_scores(scoring.score_stream(stream, fitted[0], counts), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    batch = models.score_calls(scoring.live_features(raw, counts), fitted[0], keep=scoring.KEPT)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == raw.count()
    assert got.exceptAll(batch).count() == 0


def test_stream_features_equal_those_of_training(spark, raw, data, fitted, tmp_path):
    """A labelled call gets the features its model was trained on, spelled and counted alike."""
    train.save_for_scoring(data, fitted[0], str(tmp_path / "job"))
    loaded, counts = train.load_for_scoring(spark, str(tmp_path / "job"))
    assert loaded.features == data.features
    live = scoring.live_features(raw, counts).select("call_id", *data.features).distinct()
    known = data.table.select("call_id", *data.features)
    assert known.exceptAll(live).count() == 0


def test_stream_drops_repeats(spark, raw, tmp_path):
    raw.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = scoring.drop_repeated_calls(scoring.read_call_stream(spark, str(tmp_path / "in")), "60 days")
    scoring.write_scores(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.exceptAll(raw.distinct()).count() == 0 and got.count() == raw.distinct().count()


def test_models_score_in_a_session_that_has_observed(spark):
    """What was observed stays with the session, which a model must not send along."""
    rows = [(f"c{i}", i % 2, float(i % 7 + 3 * (i % 2)), float(i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "call_id string, is_fraud int, a double, b double")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 60
    for member in (models.fit_logistic(df, ["a", "b"], scaled=False), models.fit_forest(df, ["a", "b"], trees=3)):
        assert member.score(df).filter(F.col(f"{member.name}_p").between(0, 1)).count() == 60


def test_permutation_scores_only_calls_that_change(spark):
    rows = [(f"c{i}", i % 2, 1.0 if i == 5 else None, float(i % 9)) for i in range(40)]
    df = spark.createDataFrame(rows, "call_id string, is_fraud int, a double, b double").repartition(3)
    seen = []

    class Spied(models.FixedScore):
        def score(self, df):
            seen.append(df)
            return super().score(df)

    fixed = Spied("fixed", ["a", "b"], "coalesce(a, 0) + b / 10")
    table = {r["feature"]: r for r in audits.permutation_importance(df, fixed, repeats=2).collect()}
    assert set(table) == {"a", "b"} and table["b"]["std"] > 0
    # The one value of ``a`` leaves its call and comes to another.
    assert [x.count() for x in seen][0] == 40 and seen[1].filter("feature = 'a'").count() == 4
    assert seen[1].filter("feature = 'b'").count() <= 80
