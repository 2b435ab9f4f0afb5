import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from ringwatch.operators import features as feat
from ringwatch.operators import keyed, ordered, trailing


def test_running_totals_and_row_numbers_over_slices(spark):
    rng = random.Random(1)
    keys = rng.sample(range(100000), 2000)
    df = spark.createDataFrame([(k, rng.randrange(5)) for k in keys], "k int, n long").repartition(4)
    got = ordered.running_totals(df, ["k"], ["n"]).orderBy("k").collect()
    total = 0
    for row in got:
        assert row["n_before"] == total
        total += row["n"]
    numbered = ordered.row_numbers(df, ["k"]).orderBy("k").collect()
    assert [r["row_no"] for r in numbered] == list(range(1, 2001))
    assert df.orderBy("k").checkpoint().select(F.spark_partition_id()).distinct().count() > 1


def test_running_totals_have_no_one_task_window_over_rows(spark):
    df = spark.range(100).withColumn("n", F.lit(1))
    plan = ordered.running_totals(df, ["id"], ["n"])._jdf.queryExecution().optimizedPlan().toString()
    # The only window without a key runs over one row per slice.
    assert plan.count("Window") == 2 and "Aggregate [__slice" in plan


def test_medians(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 1.0, 2.0, rng.random()]), float(i % 7)) for i in range(501)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(4)
    got = {(r["g"], r["column"]): r["median"] for r in ordered.exact_medians(df, ["x", "y"], ["g"]).collect()}
    for g in ("a", "b", None):
        for i, name in ((1, "x"), (2, "y")):
            values = [r[i] for r in rows if r[0] == g and r[i] is not None]
            assert got[(g, name)] == pytest.approx(statistics.median(values))
    assert ordered.median_values(df, ["y"]) == {"y": statistics.median(r[2] for r in rows)}


def test_median_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert ordered.median_values(df, ["x"]) == {}


def test_attach_splits_heavy_keys(spark):
    df = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, None).otherwise(F.col("id").cast("string")).alias("k")
    )
    counts = df.filter("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    got = keyed.attach_per_key(df, counts, ["k"], "n", ["id"])
    assert got.count() == 6000
    assert got.filter("k = 'hot'").agg(F.min("n"), F.max("n"), F.count("*")).first()[:] == (2000, 2000, 2000)
    assert got.filter("k is null and n is not null").count() == 0
    assert got.filter("k is not null and n is null").count() == 0


def brute(rows):
    out = {}
    for r in rows:
        mine = [x for x in rows if x["caller_number"] == r["caller_number"] is not None and x["ts"] and r["ts"]]
        now = r["ts"]
        day = [x for x in mine if now and now - dt.timedelta(hours=24) <= x["ts"] < now]
        week = [x for x in mine if now and now - dt.timedelta(days=7) <= x["ts"] < now]
        durations = [x["duration_sec"] for x in rows if x["caller_number"] == r["caller_number"] is not None and x["duration_sec"] is not None]
        out[r["call_id"]] = (
            len(day),
            len({x["called_number"] for x in week} - {None}),
            pytest.approx(sum(durations) / len(durations)) if durations else None,
        )
    return out


def check_trailing(calls, rows):
    df = calls(*[{**r, "ts": r["ts"] and str(r["ts"]), "complaint_text": None} for r in rows]).repartition(4)
    got = {
        r["call_id"]: (r[trailing.CALLS_24H], r[trailing.VICTIMS_7D], r[trailing.MEAN_DURATION])
        for r in trailing.add_trailing_features(df).collect()
    }
    assert got == brute(rows)


def test_trailing_edges(calls):
    t = dt.datetime(2026, 5, 25, 12)
    times = [t - dt.timedelta(hours=24), t - dt.timedelta(hours=24, seconds=1), t, t, None,
             t - dt.timedelta(days=7), t - dt.timedelta(days=7, seconds=1), t + dt.timedelta(days=30)]
    rows = [
        {"call_id": f"c{i}", "caller_number": "a", "called_number": v, "ts": x, "duration_sec": float(i)}
        for i, (x, v) in enumerate(zip(times, ["p", "q", "r", "r", "s", "u", "w", None]))
    ]
    rows.append({"call_id": "n", "caller_number": None, "called_number": "p", "ts": t, "duration_sec": 1.0})
    check_trailing(calls, rows)
    assert brute(rows)["c2"][:2] == (1, 3) and brute(rows)["n"] == (0, 0, None)


@pytest.mark.parametrize("seed", range(3))
def test_trailing_with_a_hot_caller(calls, seed):
    rng = random.Random(seed)
    start = dt.datetime(2026, 3, 1)
    rows = []
    for i in range(450):
        hot = i % 3 == 0
        rows.append(
            {
                "call_id": f"c{i}",
                "caller_number": "hot" if hot else rng.choice(["a", "b", "c", None]),
                "called_number": rng.choice(["v1", "v2", "v3", None]) if hot else f"w{rng.randrange(40)}",
                # Coarse times make ties and exact window edges frequent.
                "ts": None if rng.random() < 0.03 else start + dt.timedelta(hours=rng.randrange(24 * 40) // 6 * 6),
                "duration_sec": None if rng.random() < 0.1 else float(rng.randrange(300)),
            }
        )
    check_trailing(calls, rows)


def test_trailing_plan_has_no_window_over_calls(labelled):
    plan = trailing.add_trailing_features(labelled)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert windows and all("caller_number" not in w or "week" in w or "__slice" in w for w in windows)


def test_mean_durations_from_training_only(calls):
    df = calls(
        {"call_id": "a", "caller_number": "1", "called_number": "x", "ts": "2026-05-25 12:00", "duration_sec": 10.0, "complaint_text": "pank"},
        {"call_id": "b", "caller_number": "1", "called_number": "x", "ts": "2026-05-26 12:00", "duration_sec": 30.0, "complaint_text": None},
    )
    got = trailing.add_trailing_features(df, df.filter("call_id = 'a'")).orderBy("call_id").collect()
    assert [r[trailing.MEAN_DURATION] for r in got] == [10.0, 10.0]
    assert [r[trailing.KEYWORD_SCORE] for r in got] == [1, 0]


@pytest.mark.parametrize("n", [1, 7, 10])
def test_time_split_sizes_and_ties(calls, n):
    df = calls(*[{"call_id": f"c{i:02d}", "ts": "2026-05-25 12:00" if i % 2 else None} for i in range(n)])
    got = feat.add_time_split(df).collect()
    train = [r["call_id"] for r in got if r["split"] == "train"]
    ordered_ids = [f"c{i:02d}" for i in range(n) if i % 2] + [f"c{i:02d}" for i in range(n) if not i % 2]
    assert sorted(train) == sorted(ordered_ids[: int(n * 0.8)])


def test_stratified_split(labelled):
    parts = feat.stratified_split(labelled).groupBy("is_fraud").agg(
        F.count("*").alias("n"), F.count_if(F.col("split") == "validation").alias("v")
    )
    for r in parts.collect():
        assert r["v"] == -(-r["n"] // 5)


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "x double, c double")
    got = feat.scale(df, feat.fit_scaling(df, ["x", "c"])).collect()
    assert [tuple(r) for r in got] == [(-1.0, 0.0), (1.0, 0.0), (None, 0.0)]


def test_columns_to_scale(data):
    from ringwatch.plans.prepare import KEPT
    from ringwatch.schema import SCALED_FEATURES

    assert feat.columns_to_scale(data.table, not_features=KEPT) == SCALED_FEATURES


def test_fit_on_train_leaves_the_future_out(raw):
    from ringwatch.plans.prepare import feature_table, labelled_table

    whole = feature_table(labelled_table(raw))
    train_only = feature_table(labelled_table(raw), fit_on_train=True)
    n = whole.table.count()
    assert whole.table.agg(F.max("caller_number_prefix_freq")).first()[0] <= n
    assert train_only.table.agg(F.max("caller_number_prefix_freq")).first()[0] <= int(0.8 * n)
    assert train_only.train.count() == int(0.8 * n)
