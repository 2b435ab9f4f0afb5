import datetime as dt

import pytest
from pyspark.sql import functions as F

from ringwatch.functions import risk, texts, times
from ringwatch.operators import cleaning
from ringwatch.operators.features import add_temporal_features, one_hot_channel
from ringwatch.sources.calls import parse_failures

# One instant of our own for each of the six forms, winter and summer.
GOLDEN = [
    ("2024-02-29 23:59:58", "2024-02-29 23:59:58"),
    ("07/11/2023 06:05", "2023-11-07 06:05:00"),
    ("08-31-25 18:40:01", "2025-08-31 18:40:01"),
    ("2024-07-01T08:15:30+05:30", "2024-07-01 05:45:30"),
    ("1700000000", "2023-11-15 00:13:20"),
    ("03.12.2024 kell 21:09", "2024-12-03 21:09:00"),
]
EDGES = [
    (None, None),
    ("rubbish", None),
    ("", None),
    ("31/02/2026 10:00", None),
    ("12345678901234", None),
    ("05/25/2026 12:00", "2026-05-25 12:00:00"),
    ("25-05-26 12:00:00", "2026-05-25 12:00:00"),
    ("05-25-75 10:00:00", "1975-05-25 10:00:00"),
    ("2026-05-25T12:00:00.5Z", "2026-05-25 15:00:00"),
    ("2026-05-25 12:00:00 +0200", "2026-05-25 13:00:00"),
    (" 2026-05-25 12:00:00.75 ", "2026-05-25 12:00:00"),
    ("2026-01-15T12:00:00Z", "2026-01-15 14:00:00"),  # winter time
    ("2026-10-25T00:30:00Z", "2026-10-25 03:30:00"),  # the hour that comes twice
    ("2026-10-25T01:30:00Z", "2026-10-25 03:30:00"),
    ("2026-03-29 03:30", "2026-03-29 03:30:00"),  # the hour that is skipped
]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Tallinn", "America/New_York"])
def test_timestamps_in_every_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(r,) for r, _ in GOLDEN + EDGES], "t string").repartition(1)
        got = [r[0] for r in df.select(times.normalize_timestamp(F.col("t")).cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [e for _, e in GOLDEN + EDGES]


def test_parse_failures_and_strict(spark, calls):
    df = calls({"timestamp": None}, {"timestamp": "rubbish"}, {"timestamp": ""}, {"timestamp": "1779624000"})
    assert tuple(parse_failures(df).first()) == (4, 3, 2)
    strict = times.normalize_timestamp_strict(F.col("timestamp"))
    assert df.filter("timestamp is null").select(strict).first()[0] is None
    with pytest.raises(Exception, match="Could not parse timestamp: rubbish"):
        df.filter("timestamp = 'rubbish'").select(strict).collect()


def test_calendar_features(calls):
    rows = ["2026-05-23 10:00", "2026-05-25 08:59", "2026-05-25 09:00", "2026-05-25 16:59", "2026-05-25 17:00", None]
    got = add_temporal_features(calls(*[{"call_id": str(i), "ts": t} for i, t in enumerate(rows)])).orderBy("call_id")
    assert [r["is_business_hours"] for r in got.collect()] == [False, False, True, True, False, False]
    assert [r["is_weekend"] for r in got.collect()] == [True, False, False, False, False, False]
    assert [r["weekday"] for r in got.collect()] == [5, 0, 0, 0, 0, None]


def test_weekday_names_and_minute(calls):
    row = calls({"ts": "2026-05-24 10:15:42"}).select(
        times.weekday_name(F.col("ts")), times.floor_minute(F.col("ts"))
    ).first()
    assert tuple(row) == ("Sunday", dt.datetime(2026, 5, 24, 10, 15))


def test_spellings_are_exact(calls):
    df = calls(
        {"channel": "MOBILE", "label_5way": "confirmed-fraud"},
        {"channel": "LANDLINE", "label_5way": " Verified-Legitimate "},
        {"channel": None, "label_5way": None},
    )
    cleaned = cleaning.clean_categories(df).collect()
    assert [r["channel"] for r in cleaned] == ["Mobile", "LANDLINE", None]
    assert cleaned[0]["label_5way"] == "confirmed-fraud"
    canonical = [r[0] for r in df.select(texts.canonical_label(F.col("label_5way"))).collect()]
    assert canonical == ["confirmed_fraud", "verified_legitimate", None]


def test_keywords(calls):
    df = calls(
        {"complaint_text": "Helistati PANGAST, küsiti smart id"},
        {"complaint_text": "Kahtlane pank, pank"},
        {"complaint_text": None},
    )
    flags = texts.keyword_flags(F.col("complaint_text"))
    first = df.select(*[c.alias(n) for n, c in flags.items()]).collect()
    assert [n for n, v in first[0].asDict().items() if v] == ["bank (pank/panga)", "Smart-ID"]
    assert not any(first[1]) and not any(first[2])
    assert [r[0] for r in df.select(texts.keyword_score(F.col("complaint_text"))).collect()] == [1, 2, 0]


def test_acted_within(calls):
    df = calls(*[{"login_after_call": f, "time_to_next_action_min": m} for f, m in
                 [(True, None), (True, 60.0), (True, 60.01), (False, 5.0), (None, 5.0)]])
    got = df.select(risk.acted_within(F.col("login_after_call"), F.col("time_to_next_action_min"))).collect()
    assert [r[0] for r in got] == [False, True, False, False, False]


def test_bands(spark):
    df = spark.createDataFrame([(None,), (0.4,), (0.75,), (0.399,), (1.2,), (-0.1,)], "s double")
    got = df.select(risk.risk_level(F.col("s")), risk.clamp_score(F.col("s"))).collect()
    assert [r[0] for r in got] == ["Unknown", "Medium", "High", "Low", "High", "Low"]
    assert [r[1] for r in got] == [None, 0.4, 0.75, 0.399, 1.0, 0.0]
    rates = spark.createDataFrame([(0.6, 50), (0.6, 29), (0.6, 40), (0.05, 9), (0.5, 99)], "r double, n int")
    got = rates.select(risk.caller_band(F.col("r")), risk.caller_pattern(F.col("r"), F.col("n"))).collect()
    assert [tuple(r) for r in got] == [
        ("red", "mass"), ("red", "targeted"), ("red", "other"), ("blue", "legitimate"), ("orange", "other")
    ]
    p = spark.createDataFrame([(0.29,), (0.3,), (0.7,)], "p double").select(risk.probability_band(F.col("p")))
    assert [r[0] for r in p.collect()] == ["Low", "Medium", "High"]


def test_one_hot(calls):
    df = calls(*[{"call_id": str(i), "channel": c} for i, c in enumerate(["Landline", None, "Mobile", "VoIP"])])
    got = one_hot_channel(df).orderBy("call_id").collect()
    assert [(r["channel_Mobile"], r["channel_VoIP"]) for r in got] == [(0, 0), (0, 0), (1, 0), (0, 1)]


def test_align_and_first_present(calls):
    df = calls({"call_id": "a", "duration_sec": 3.0})
    assert cleaning.align_columns(df, ["hour", "duration_sec"]).first().asDict() == {"hour": 0, "duration_sec": 3.0}
    assert cleaning.first_present(df, ["number", "call_id"]) == "call_id"
    assert cleaning.first_present(df, ["number"]) is None
