"""Column names, types and vocabularies of the call table."""

from __future__ import annotations

from pyspark.sql import types as T

# Declared, never inferred: inference would read "+372..." as a number.
CALLS = T.StructType(
    [
        T.StructField("call_id", T.StringType()),
        T.StructField("caller_number", T.StringType()),
        T.StructField("called_number", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("was_answered", T.BooleanType()),
        T.StructField("channel", T.StringType()),
        T.StructField("was_hangup_by_client", T.BooleanType()),
        T.StructField("login_after_call", T.BooleanType()),
        T.StructField("twofa_confirmed_after_call", T.BooleanType()),
        T.StructField("transfer_after_call", T.BooleanType()),
        T.StructField("new_payee_after_call", T.BooleanType()),
        T.StructField("settings_changed_after_call", T.BooleanType()),
        T.StructField("time_to_next_action_min", T.DoubleType()),
        T.StructField("complaint_text", T.StringType()),
        T.StructField("manual_severity", T.DoubleType()),
        T.StructField("label_5way", T.StringType()),
        T.StructField("confidence_score", T.DoubleType()),
    ]
)
CALL_COLUMNS = CALLS.fieldNames()

# --- Fixed values: they must equal the published ones for equal results. ---

TIME_ZONE = "Europe/Tallinn"

CHANNEL_SPELLINGS = {
    "landline": "Landline",
    "MOBILE": "Mobile",
    "mobile": "Mobile",
    "voip": "VoIP",
    "voIP": "VoIP",
}

LABEL_SPELLINGS = {
    "unknown": "Unknown",
    "UNKNOWN": "Unknown",
    "CONFIRMED_FRAUD": "Confirmed_Fraud",
    "confirmed_fraud": "Confirmed_Fraud",
    "verified-legitimate": "Verified_Legitimate",
    "verified_legitimate": "Verified_Legitimate",
    "high-risk-reported": "High_Risk_Reported",
    "high_risk_reported": "High_Risk_Reported",
    "community_flagged": "Community_Flagged",
    "community-flagged": "Community_Flagged",
}

# Order of the label axis in keyword tables.
LABELS = [
    "Confirmed_Fraud",
    "High_Risk_Reported",
    "Community_Flagged",
    "Unknown",
    "Verified_Legitimate",
]
FRAUD_LABELS = ["Confirmed_Fraud", "High_Risk_Reported"]
LEGITIMATE_LABELS = ["Verified_Legitimate"]

# The quality checks compare labels in lower snake case.
CANONICAL_LABELS = [
    "confirmed_fraud",
    "high_risk_reported",
    "community_flagged",
    "unknown",
    "verified_legitimate",
]
CANONICAL_FRAUD_LABELS = ["confirmed_fraud", "high_risk_reported"]

# Keyword name -> pattern, matched once per complaint, ignoring case.
KEYWORD_PATTERNS = {
    "bank (pank/panga)": r"pang",
    "fraud (pettus)": r"pettus",
    "suspicious (kahtlane)": r"kahtlas",
    "secure account (turvakonto)": r"turvakont",
    "Mobiil-ID": r"mobiil[\-\s]?id",
    "Smart-ID": r"smart[\-\s]?id",
    "transaction (tehing)": r"tehing",
    "card (kaart)": r"kaardi|kaart",
}

# Words counted by the complaint keyword score.
SCORE_WORDS = [
    "pettus",
    "kahtlane",
    "turvakonto",
    "mobiil-id",
    "smart-id",
    "tehing",
    "kaart",
    "pank",
    "panga",
]

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Seconds within which two durations of one call count as the same call.
NEAR_DUPLICATE_SECONDS = 5

PREFIX_DIGITS = 5
TEST_SHARE = 0.2
MAX_RATE_GAP_PP = 1.0

# Names of columns and features, in the order in which models and tables have them.
ACTION_FLAGS = [
    "login_after_call",
    "twofa_confirmed_after_call",
    "transfer_after_call",
    "new_payee_after_call",
    "settings_changed_after_call",
]

# Never features: identifiers, free text, the label, and the score made from it.
IDENTIFIER_COLUMNS = [
    "call_id",
    "caller_number",
    "called_number",
    "timestamp",
    "complaint_text",
    "label_5way",
]
LEAK_COLUMNS = ["confidence_score"]

BASE_FEATURES = [
    "duration_sec",
    "was_answered",
    "was_hangup_by_client",
    *ACTION_FLAGS,
    "time_to_next_action_min",
    "manual_severity",
    "hour",
    "weekday",
    "is_weekend",
    "is_business_hours",
    "caller_number_prefix_freq",
    "channel_Mobile",
    "channel_VoIP",
]
TRAILING_FEATURES = [
    "calls_from_number_last_24h",
    "distinct_victims_last_7d",
    "mean_call_duration_per_number",
    "complaint_keyword_score",
]
BEHAVIORAL_FEATURES = BASE_FEATURES + TRAILING_FEATURES

SCALED_FEATURES = [
    "duration_sec",
    "time_to_next_action_min",
    "manual_severity",
    "hour",
    "weekday",
    "caller_number_prefix_freq",
]

PROJECTION_COLUMNS = [
    "caller_number",
    "called_number",
    "timestamp",
    "duration_sec",
    "was_answered",
    "channel",
    "was_hangup_by_client",
    *ACTION_FLAGS,
    "time_to_next_action_min",
    "label_5way",
    "confidence_score",
]

# --- End of fixed values. ---
