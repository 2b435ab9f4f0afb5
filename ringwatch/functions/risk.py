"""Fraud flags, bands and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringwatch.schema import FRAUD_LABELS

# --- Fixed values: the published band limits. ---
CONFIDENCE_HIGH = 0.75
CONFIDENCE_MEDIUM = 0.4
PROBABILITY_MEDIUM = 0.3
PROBABILITY_HIGH = 0.7
RATE_RED = 0.5
RATE_ORANGE = 0.2
MASS_CALLS = 50
TARGETED_CALLS = 30
LEGITIMATE_RATE = 0.1
ACTION_MINUTES = 60
# --- End of fixed values. ---


def fraud_flag(label: Column, fraud_labels: Sequence[str] = FRAUD_LABELS) -> Column:
    """1 for a fraud label, 0 for any other and for null."""
    return F.coalesce(label.isin(list(fraud_labels)), F.lit(False)).cast("int")


def caller_band(fraud_rate: Column) -> Column:
    return (
        F.when(fraud_rate > RATE_RED, "red")
        .when(fraud_rate > RATE_ORANGE, "orange")
        .otherwise("blue")
    )


def caller_pattern(fraud_rate: Column, total_calls: Column) -> Column:
    """Mass campaign, targeted attempt or legitimate-looking; the classes leave gaps."""
    fraudulent = fraud_rate > RATE_RED
    return (
        F.when(fraudulent & (total_calls >= MASS_CALLS), "mass")
        .when(fraudulent & (total_calls < TARGETED_CALLS), "targeted")
        .when(fraud_rate < LEGITIMATE_RATE, "legitimate")
        .otherwise("other")
    )


def risk_level(confidence: Column) -> Column:
    """Level of a mean label confidence."""
    return (
        F.when(confidence.isNull(), "Unknown")
        .when(confidence >= CONFIDENCE_HIGH, "High")
        .when(confidence >= CONFIDENCE_MEDIUM, "Medium")
        .otherwise("Low")
    )


def probability_band(probability: Column) -> Column:
    """Level of a model's fraud probability."""
    return (
        F.when(probability < PROBABILITY_MEDIUM, "Low")
        .when(probability < PROBABILITY_HIGH, "Medium")
        .otherwise("High")
    )


def clamp_score(score: Column) -> Column:
    """Into [0, 1]; null stays null, which ``least`` and ``greatest`` alone would skip."""
    return F.when(score.isNotNull(), F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)))


def acted_within(flag: Column, minutes: Column, limit: float = ACTION_MINUTES) -> Column:
    """The action was taken and in time; an unknown time counts as not in time."""
    return F.coalesce(flag & (minutes <= limit), F.lit(False))


def target_name(is_fraud: Column) -> Column:
    return (
        F.when(is_fraud == 0, "Not fraud").when(is_fraud == 1, "Fraud").otherwise(is_fraud.cast("string"))
    )
