import random

import pytest

from ringwatch.operators import dedup, quality

KEY = {"caller_number": "1", "called_number": "2", "ts": "2026-05-25 12:00:10"}


def rows(durations, **fixed):
    return [{**KEY, **fixed, "call_id": f"c{i}", "duration_sec": d} for i, d in enumerate(durations)]


def kept(df):
    return sorted(r["call_id"] for r in df.collect())


def test_near_duplicates_follow_the_sorted_neighbour(calls):
    # 104 falls to 100, 108 to 104 although that is dropped; 113 is exactly 5 off.
    df = calls(*rows([100.0, 104.0, 108.0, 114.0, 119.0, None, None]))  # two calls without duration
    assert kept(dedup.drop_near_duplicates(df)) == ["c0", "c3", "c5", "c6"]


def test_null_keys_group_together(calls):
    df = calls(*rows([10.0, 12.0], caller_number=None))
    assert kept(dedup.drop_near_duplicates(df)) == ["c0"]


def test_other_minute_is_another_call(calls):
    df = calls({**KEY, "call_id": "a", "duration_sec": 10.0}, {**KEY, "ts": "2026-05-25 12:01:00", "call_id": "b", "duration_sec": 10.0})
    assert kept(dedup.drop_near_duplicates(df)) == ["a", "b"]


def test_exact_duplicates_with_nulls(calls):
    one = {"call_id": "a", "caller_number": None, "duration_sec": None}
    assert dedup.drop_exact_duplicates(calls(one, one, {**one, "call_id": "b"})).count() == 2


@pytest.mark.parametrize("tolerance", [0, 1, 5, 7.5])
def test_against_a_plain_loop_with_one_hot_group(calls, tolerance):
    rng = random.Random(int(tolerance * 10))
    table = []
    for i in range(400):
        hot = i % 3 == 0  # a third of the rows share one key
        table.append(
            {
                "call_id": f"c{i:04d}",
                "caller_number": "hot" if hot else rng.choice(["a", "b", None]),
                "called_number": "x" if hot else rng.choice(["y", "z"]),
                "ts": f"2026-05-25 12:{0 if hot else rng.randrange(3):02d}:{rng.randrange(60):02d}",
                "duration_sec": rng.choice([None, *map(float, range(0, 600, 3 if hot else 1))]),
            }
        )
    table += table[:40]
    distinct = list({tuple(r.items()): r for r in table}.values())
    groups = {}
    for r in distinct:
        groups.setdefault((r["caller_number"], r["called_number"], r["ts"][:16]), []).append(r)
    expected, dropped, dirty = [], 0, 0
    for members in groups.values():
        timed = sorted((r for r in members if r["duration_sec"] is not None), key=lambda r: (r["duration_sec"], r["call_id"]))
        lost = 0
        for i, r in enumerate(timed):
            if i and r["duration_sec"] - timed[i - 1]["duration_sec"] <= tolerance:
                lost += 1
            else:
                expected.append(r["call_id"])
        expected += [r["call_id"] for r in members if r["duration_sec"] is None]
        dropped, dirty = dropped + lost, dirty + bool(lost)
    df = calls(*table).repartition(4)
    assert kept(dedup.dedup(df, tolerance)) == sorted(expected)
    report = dedup.dedup_report(df, tolerance).first().asDict()
    assert report == {
        "rows_before": 440,
        "exact_duplicates": 440 - len(distinct),
        "near_duplicates": dropped,
        "rows_after": len(expected),
        "near_dup_groups": dirty,
    }


def test_dedup_combines_before_the_shuffle(calls):
    plan = dedup.dedup(calls(*rows([1.0, 2.0])))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Python" not in plan


def test_the_table_is_read_once(spark):
    from ringwatch.sources.calls import with_parsed_time
    from ringwatch.sources.event_calls import read_event_calls

    # Not the folder whose calls the session has cached.
    df = dedup.dedup(with_parsed_time(read_event_calls(spark, "/root/testdata/sf0.01")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_key_count(calls):
    df = calls(*rows([1.0, 1.0, 2.0, None, None]))
    key = ["caller_number", "called_number", "duration_sec"]
    assert dedup.duplicate_key_count(df, key).first()[0] == 2


def test_checks_pass_and_fail(raw):
    n = raw.count()
    checks = {r["check_name"]: r["passed"] for r in quality.quality_checks(raw, (0.9 * n, 1.1 * n), (0.3, 0.5)).collect()}
    assert all(checks.values()) and len(checks) == 6
    quality.quality_gate(quality.quality_checks(raw, (0.9 * n, 1.1 * n), (0.3, 0.5)))
    with pytest.raises(quality.QualityError, match="row_count.*fraud_rate"):
        quality.quality_gate(quality.quality_checks(raw))


def test_checks_find_each_fault(calls):
    df = calls(
        {"label_5way": "nonsense", "duration_sec": 3601.0, "confidence_score": 0.5},
        {"label_5way": None, "duration_sec": None, "confidence_score": -0.1},
    )
    got = {r["check_name"]: r["passed"] for r in quality.quality_checks(df, (1, 2), (0, 1)).collect()}
    assert got == {
        "required_columns": False, "row_count": True, "fraud_rate": True,
        "known_labels": False, "duration_range": False, "confidence_range": False,
    }
    messages = {r["check_name"]: r["message"] for r in quality.quality_checks(df, (1, 2), (0, 1)).collect()}
    assert messages["known_labels"] == "rows: 1, labels: nonsense"
    assert [r[0] for r in quality.unknown_labels(df).collect()] == ["nonsense"]
    assert len(quality.quality_checks(df.drop("duration_sec", "confidence_score")).collect()) == 4


def test_null_profile(calls):
    df = calls({"call_id": "a", "channel": None}, {"call_id": None, "channel": None}, {"call_id": "b", "channel": None})
    assert {tuple(r) for r in quality.null_profile(df).collect()} == {("call_id", 1), ("channel", 3)}
    assert tuple(quality.table_facts(df).first()) == (3, 2, 4)


def test_a_table_without_labels_fails_by_its_columns(raw):
    checks = {r["check_name"]: r for r in quality.quality_checks(raw.drop("label_5way"), (0, 10**9)).collect()}
    assert not checks["required_columns"]["passed"] and "label_5way" in checks["required_columns"]["message"]
    assert "fraud_rate" not in checks and checks["row_count"]["passed"]


def test_all_odd_labels_are_named(calls):
    df = calls(*[{"call_id": f"c{k}", "label_5way": f"odd{k:02d}"} for k in range(14)])
    message = next(r["message"] for r in quality.quality_checks(df).collect() if r["check_name"] == "known_labels")
    assert message == "rows: 14, labels: " + ", ".join(f"odd{k:02d}" for k in range(14))


def test_only_a_sound_table_is_written(spark, raw, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    quality.write_checked(raw, good, (1, 10**9), (0.3, 0.5))
    back = spark.read.parquet(good)
    assert back.exceptAll(raw).count() == 0 and back.count() == raw.count()
    with pytest.raises(quality.QualityError, match="fraud_rate"):
        quality.write_checked(raw, bad, (1, 10**9))
    with pytest.raises(FileExistsError):
        quality.write_checked(raw, good, (1, 10**9), (0.3, 0.5))
    assert [p.name for p in tmp_path.iterdir()] == ["good"]
