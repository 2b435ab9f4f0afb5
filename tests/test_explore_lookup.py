import datetime as dt
import math

from pyspark.sql import functions as F

from ringwatch.functions.risk import fraud_flag
from ringwatch.operators import cleaning, explore, lookup


def test_caller_profile_drops_unknown_callers(calls):
    df = calls(
        {"call_id": "a", "caller_number": "1", "called_number": "x", "label_5way": "Confirmed_Fraud", "duration_sec": 10.0},
        {"call_id": "b", "caller_number": "1", "called_number": None, "label_5way": None, "duration_sec": None},
        {"call_id": "c", "caller_number": None, "called_number": "x", "label_5way": "Unknown", "duration_sec": 1.0},
    )
    assert [tuple(r) for r in explore.caller_profile(df).collect()] == [("1", 2, 1, 0.5, 10.0)]


def test_ranking_has_a_minimum_and_stable_ties(calls):
    rows = [{"call_id": f"{n}{i}", "caller_number": n, "called_number": "x", "label_5way": "Confirmed_Fraud", "duration_sec": 1.0}
            for n in "abc" for i in range(3 if n != "c" else 2)]
    profile = explore.caller_profile(calls(*rows))
    assert [r[0] for r in explore.top_suspicious(profile, n=2, min_calls=3).collect()] == ["a", "b"]
    assert tuple(explore.caller_counts(profile, 3).first()) == (3, 2)


def test_lift_is_infinite_where_others_lack_the_word(calls):
    df = calls(
        {"label_5way": "Confirmed_Fraud", "complaint_text": "Pettus ja kaart"},
        {"label_5way": "Confirmed_Fraud", "complaint_text": None},
        {"label_5way": "Unknown", "complaint_text": "kaardi number"},
    )
    counts = explore.keyword_counts(df)
    assert [r["n_complaints"] for r in counts.collect()] == [2, 0, 0, 1, 0]
    lift = {r["keyword"]: r for r in explore.keyword_lift(counts).collect()}
    assert math.isinf(lift["fraud (pettus)"]["lift"]) and lift["fraud (pettus)"]["fraud_share"] == 0.5
    assert lift["card (kaart)"]["lift"] == 0.5
    assert math.isinf(lift["bank (pank/panga)"]["lift"])  # nobody has it: nothing to divide by
    assert all(r["card (kaart)"] == 0.0 for r in explore.keyword_shares(counts).filter("label = 'Community_Flagged'").collect())


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1), (2.0, 5.0, 0), (None, 5.0, 1), (4.0, 5.0, 0)], "x double, c double, y int")
    got = {r[0]: r[1] for r in explore.feature_correlations(df, ["x", "c"], F.col("y")).collect()}
    assert got["c"] is None and abs(got["x"] + 0.7559289460184544) < 1e-12


def test_heatmap_has_every_day(calls):
    df = calls({"label_5way": "Confirmed_Fraud", "ts": "2026-05-25 09:30"}, {"label_5way": "Unknown", "ts": "2026-05-26 09:30"})
    grid = explore.call_heatmap_pivot(df).collect()
    assert [r["day_of_week"] for r in grid][:2] == ["Monday", "Tuesday"] and len(grid) == 7
    assert grid[0]["h09"] == 1 and grid[1]["h09"] is None and len(grid[0]) == 26


def test_target_summary(calls):
    df = calls(*[{"label_5way": x} for x in ["Confirmed_Fraud", "Verified_Legitimate", "High_Risk_Reported", "Unknown", None]])
    got = {r["label"]: r for r in cleaning.target_summary(df).collect()}
    assert got["Fraud"]["n"] == 2 and got["Not fraud"]["rows_dropped"] == 2
    assert cleaning.build_targets(df).count() == 3
    assert [r[0] for r in df.select(fraud_flag(F.col("label_5way"))).collect()] == [1, 0, 1, 0, 0]


def history(calls):
    return calls(
        {"call_id": "a", "caller_number": "372500", "ts": "2026-05-25 23:59:59", "label_5way": "B", "channel": "VoIP", "confidence_score": 0.9, "duration_sec": 10.0},
        {"call_id": "b", "caller_number": "3725001", "ts": "2026-05-26 00:00:00", "label_5way": "A", "channel": None, "confidence_score": None, "duration_sec": 11.5},
        {"call_id": "c", "caller_number": "372500", "ts": None, "label_5way": "A", "channel": "Mobile", "confidence_score": 0.5, "duration_sec": None},
        {"call_id": "d", "caller_number": "9", "ts": "2026-05-20 10:00:00", "label_5way": "B", "channel": "Mobile", "confidence_score": None, "duration_sec": None},
    )


def ids(df):
    return [r["call_id"] for r in df.collect()]


def test_filters(calls):
    df = history(calls)
    assert sorted(ids(lookup.filter_calls(df, labels=[], channels=[], prefix="+"))) == ["a", "b", "c", "d"]
    assert ids(lookup.filter_calls(df, dt.date(2026, 5, 25), dt.date(2026, 5, 25))) == ["a"]
    assert sorted(ids(lookup.filter_calls(df, prefix="+372 500"))) == ["a", "b", "c"]
    assert ids(lookup.filter_calls(df, labels=["B"], channels=["Mobile"])) == ["d"]


def test_filters_reach_the_files(spark, calls, tmp_path):
    path = str(tmp_path / "calls")
    history(calls).write.parquet(path)
    found = lookup.filter_calls(spark.read.parquet(path), dt.date(2026, 5, 25), None, ["A"], "3725", ["VoIP"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    for part in ("GreaterThanOrEqual(ts", "EqualTo(label_5way", "EqualTo(channel", "StringStartsWith(caller_number"):
        assert part in pushed


def test_lookup_prefers_exact_numbers(calls):
    df = history(calls)
    assert ids(lookup.lookup_history(df, "+372 500")) == ["a", "c"]
    assert ids(lookup.lookup_history(df, "37250")) == ["b", "a", "c"]  # newest first, no time last
    assert ids(lookup.lookup_history(df, "")) == [] and ids(lookup.lookup_history(df, "abc")) == []


def test_risk_of_a_number(calls):
    df = history(calls)
    assert tuple(lookup.risk_info(lookup.matching_calls(df, "372500")).first()) == (0.7, "Medium", 2)
    assert tuple(lookup.risk_info(lookup.matching_calls(df, "9")).first()) == (None, "Unknown", 1)
    assert tuple(lookup.risk_info(lookup.matching_calls(df, "777")).first()) == (None, "Unknown", 0)
    assert {r["caller_number"]: r["risk_level"] for r in lookup.number_risk(df).collect()} == {
        "372500": "Medium", "3725001": "Unknown", "9": "Unknown"
    }


def test_summary_breaks_ties_downwards(calls):
    got = lookup.history_summary(lookup.matching_calls(history(calls), "372500")).first()
    assert tuple(got) == (2, "A", "Mobile", 10.0)


def test_options_and_dates(calls):
    df = history(calls)
    assert [tuple(r) for r in explore.filter_options(df).collect()] == [
        ("channel", "Mobile"), ("channel", "VoIP"), ("label", "A"), ("label", "B")
    ]
    assert tuple(explore.date_range(df).first()) == (dt.date(2026, 5, 20), dt.date(2026, 5, 26))
    assert [r["call_id"] for r in explore.top_k(df, 3, "confidence_score", ["call_id"]).collect()] == ["a", "c", "b"]
