"""Batches with a carried table against the whole table at once."""

import random
from datetime import datetime, timedelta

import pytest

from ringwatch.operators.dedup import dedup
from ringwatch.operators.trailing import CALLS_24H, VICTIMS_7D, add_trailing_features
from ringwatch.streaming import carried

COLUMNS = "call_id string, caller_number string, called_number string, ts timestamp_ntz, duration_sec double, complaint_text string"


def some_calls(seed, n=240, busy=0.4):
    """Calls of a few numbers, one of them busy, in time order; ties and steps of exactly a day or a week among them."""
    rng = random.Random(seed)
    at, rows = datetime(2024, 1, 1), []
    for k in range(n):
        at += rng.choice([timedelta(0), timedelta(0), timedelta(seconds=20), timedelta(hours=5), timedelta(days=1), timedelta(days=2)])
        caller = "a" if rng.random() < busy else rng.choice(["b", "c", None])
        rows.append((f"c{k}", caller, rng.choice(["x", "y", "z", None]), at, rng.choice([None, float(rng.randint(0, 30))]), None))
    return rows


def in_batches(spark, rows, cuts, step):
    """The results of a step over consecutive batches, and the last carried table."""
    out, before = [], None
    for start, stop in zip([0, *cuts], [*cuts, len(rows)]):
        result, after = step(spark.createDataFrame(rows[start:stop], COLUMNS), before)
        out += result.collect()
        before = spark.createDataFrame(after.collect(), after.schema)
    return out, before


@pytest.mark.parametrize("seed", [1, 2])
def test_trailing_features_from_what_is_carried(spark, seed):
    rows = some_calls(seed)
    whole = spark.createDataFrame(rows, COLUMNS)
    want = add_trailing_features(whole).select("call_id", CALLS_24H, VICTIMS_7D).collect()
    cuts = sorted(random.Random(seed).sample(range(1, len(rows)), 4))
    got, left = in_batches(spark, rows, cuts, carried.trailing_step(whole))
    assert sorted((r["call_id"], r[CALLS_24H], r[VICTIMS_7D]) for r in got) == sorted(map(tuple, want))
    assert max(r[VICTIMS_7D] for r in want) > 1
    # A week of pairs and a day of calls, however long the stream has run.
    latest = max(r[3] for r in rows)
    assert all(r["ts"] >= latest - timedelta(days=7) for r in left.collect())
    assert left.count() < len(rows) / 3


@pytest.mark.parametrize("seed", [3, 4])
def test_duplicates_over_batches(spark, seed):
    rng = random.Random(seed)
    rows = some_calls(seed, 150)
    # Exact copies, and near ones that arrive with a later batch of the same minute.
    rows = sorted(rows + rng.sample(rows, 30) + [(f"n{k}", *r[1:4], (r[4] or 0.0) + 3.0, r[5]) for k, r in enumerate(rng.sample(rows, 30))], key=lambda r: r[3])
    whole = dedup(spark.createDataFrame(rows, COLUMNS)).collect()
    got, left = in_batches(spark, rows, sorted(rng.sample(range(1, len(rows)), 4)), carried.dedup_step())
    got += carried.close_carried(left).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, whole)) and len(whole) < len(rows) - 20


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    rows = some_calls(5, 60)
    whole = spark.createDataFrame(rows, COLUMNS)
    step = carried.trailing_step(whole)
    folders = [str(tmp_path / name) for name in ("out", "open", "progress")]
    for start, stop in ((0, 25), (25, 25), (25, 60)):
        if start < stop:
            spark.createDataFrame(rows[start:stop], COLUMNS).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(whole.schema).parquet(str(tmp_path / "in"))
        carried.write_carried(stream, step, *folders).awaitTermination()
    got = spark.read.parquet(folders[0]).select("call_id", CALLS_24H, VICTIMS_7D).collect()
    want = add_trailing_features(whole).select("call_id", CALLS_24H, VICTIMS_7D).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_no_calls(spark):
    none = spark.createDataFrame([], COLUMNS)
    for step in (carried.trailing_step(), carried.dedup_step()):
        result, after = step(none, None)
        assert result.count() == 0 and after.count() == 0
