"""The call table as a view over the ``events`` table.

Each event becomes one call; its type plays the label. A fiftieth of the calls
comes twice, and a hundredth comes again with a duration a little off, so that
deduplication has work. Apart from the spelled time, the expressions are plain SQL
that Spark and other engines read alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.schema import CALL_COLUMNS

_FRAUD = "event_type in ('error','purchase')"
_CLOCK = r"^(..)(..)-(..)-(..) (..:..)(:..).*$"  # century, year, month, day, minute, second
# Remainder of the event number -> spelling of its time; any other is plain ISO.
_TIME_FORMS = {
    0: "$4/$3/$1$2 $5",
    1: "$3-$4-$2 $5$6",
    2: "$1$2-$3-$4T$5$6+02:00",
    3: "$4.$3.$1$2 kell $5",
}
_ISO_FORM = "$1$2-$3-$4 $5$6"

CALL_EXPRESSIONS = {
    "call_id": "concat('C', lpad(cast(event_id as string), 8, '0'))",
    "caller_number": (
        "case when user_id < 5 then concat('+3726', lpad(cast(user_id as string), 6, '0')) "
        "else concat('+3725', lpad(cast(user_id as string), 7, '0')) end"
    ),
    "called_number": "concat('+3725', lpad(cast((event_id * 7919) % 997 as string), 7, '0'))",
    "duration_sec": "case when event_id % 50 = 0 then null else cast(floor(value) + 5 as double) end",
    "was_answered": "event_id % 20 >= 3",
    "channel": (
        "case event_id % 9 when 0 then 'voip' when 1 then 'VoIP' when 2 then 'voIP' when 3 then 'mobile' "
        "when 4 then 'Mobile' when 5 then 'MOBILE' when 6 then 'landline' when 7 then 'Landline' else null end"
    ),
    "was_hangup_by_client": "event_id % 5 < 2",
    "login_after_call": f"(event_id * 17) % 100 < case when {_FRAUD} then 75 else 20 end",
    "twofa_confirmed_after_call": f"(event_id * 37) % 100 < case when {_FRAUD} then 65 else 10 end",
    "transfer_after_call": f"(event_id * 53) % 100 < case when {_FRAUD} then 55 else 5 end",
    "new_payee_after_call": f"(event_id * 71) % 100 < case when {_FRAUD} then 35 else 2 end",
    "settings_changed_after_call": f"(event_id * 89) % 100 < case when {_FRAUD} then 20 else 5 end",
    "time_to_next_action_min": (
        f"case when event_id % 20 = 7 then null when {_FRAUD} then value / 4 else value end"
    ),
    "complaint_text": (
        "case when event_id % 13 = 0 then null "
        f"when {_FRAUD} then case event_id % 4 when 0 then 'Kahtlane kõne, pettus panga nimel' "
        "when 1 then 'Kinnitas Smart-ID, raha kanti turvakontole' "
        "when 2 then 'Küsiti Mobiil ID ja kaardi numbrit' "
        "else 'Kahtlase tehingu peatamine, pank helistas' end "
        "when event_id % 6 = 0 then 'Pank tuletas meelde, kaart aegub' "
        "when event_id % 6 = 1 then 'tehingu staatus korras' else '' end"
    ),
    "manual_severity": "case when event_id % 17 = 0 then null else cast(event_id % 5 + 1 as double) end",
    "label_5way": (
        "case event_type "
        "when 'error' then case event_id % 3 when 0 then 'confirmed_fraud' when 1 then 'Confirmed_Fraud' "
        "else 'CONFIRMED_FRAUD' end "
        "when 'purchase' then case event_id % 3 when 0 then 'high_risk_reported' when 1 then 'High_Risk_Reported' "
        "else 'high-risk-reported' end "
        "when 'click' then case event_id % 2 when 0 then 'community_flagged' else 'Community_Flagged' end "
        "when 'signup' then case event_id % 3 when 0 then 'unknown' when 1 then 'Unknown' else 'UNKNOWN' end "
        "else case event_id % 3 when 0 then 'verified_legitimate' when 1 then 'Verified_Legitimate' "
        "else 'verified-legitimate' end end"
    ),
    "confidence_score": (
        "cast(case event_type when 'error' then 95 when 'view' then 95 when 'purchase' then 75 "
        "when 'click' then 55 else 35 end + event_id % 11 - 5 as double) / 100"
    ),
}
REPEATED = "event_id % 50 = 3"
NEARLY_REPEATED = "event_id % 100 = 7"
DURATION_DRIFT = "(cast(floor(event_id / 100) as int) % 5 - 2)"


def _spelled_time() -> Column:
    """The event's time in one of five spellings, from its plain text, which no time zone shifts."""
    clock = F.col("ts").cast("string")
    form = F.expr("event_id % 20")
    spelled = F.when(F.lit(False), clock)
    for remainder, shape in _TIME_FORMS.items():
        spelled = spelled.when(form == remainder, F.regexp_replace(clock, _CLOCK, shape))
    return spelled.otherwise(F.regexp_replace(clock, _CLOCK, _ISO_FORM))


def event_calls(events: DataFrame) -> DataFrame:
    """All calls with their copies, from one pass over the events."""
    copies = F.expr(
        f"filter(array(0, case when {REPEATED} then 1 end, case when {NEARLY_REPEATED} then 2 end), x -> x is not null)"
    )
    exploded = events.select("event_id", "ts", "user_id", "event_type", "value", F.explode(copies).alias("copy"))
    columns = dict(CALL_EXPRESSIONS)
    columns["duration_sec"] = (
        f"({columns['duration_sec']}) + case when copy = 2 then {DURATION_DRIFT} else 0 end"
    )
    expressions = {name: F.expr(text) for name, text in columns.items()}
    expressions["timestamp"] = _spelled_time()
    return exploded.select(*[expressions[name].alias(name) for name in CALL_COLUMNS])


def read_event_calls(spark: SparkSession, folder: str) -> DataFrame:
    return event_calls(spark.read.parquet(f"{folder}/events.parquet"))
