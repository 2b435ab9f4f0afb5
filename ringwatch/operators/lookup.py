"""Filtering calls and looking up the history of a number."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.functions.risk import clamp_score, risk_level


def _day(value: dt.date):
    return F.lit(value.isoformat()).cast("timestamp_ntz")


def filter_calls(
    df: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    labels: Sequence[str] | None = None,
    prefix: str | None = None,
    channels: Sequence[str] | None = None,
) -> DataFrame:
    """Calls that meet every given condition; an empty one is no condition.

    Both days are inclusive. Numbers are digits, as ``load_calls`` leaves them, and so
    is the prefix. Every condition is a plain comparison with a column, so on a stored
    table it reaches the file scan.
    """
    if start is not None:
        df = df.filter(F.col("ts") >= _day(start))
    if end is not None:
        df = df.filter(F.col("ts") < _day(end + dt.timedelta(days=1)))
    if labels:
        df = df.filter(F.col("label_5way").isin(list(labels)))
    if channels:
        df = df.filter(F.col("channel").isin(list(channels)))
    digits = re.sub(r"[^0-9]", "", prefix or "")
    if digits:
        df = df.filter(F.col("caller_number").startswith(digits))
    return df


def matching_calls(df: DataFrame, number: str) -> DataFrame:
    """Calls from exactly ``number`` or, if there are none, from numbers that start with it."""
    digits = re.sub(r"[^0-9]", "", number or "")
    if not digits:
        return df.limit(0)
    exact = F.col("caller_number") == digits
    any_exact = df.filter(exact).exists()
    return df.filter(F.col("caller_number").startswith(digits)).filter(exact | ~any_exact)


def lookup_history(df: DataFrame, number: str) -> DataFrame:
    """The matching calls, newest first; calls without a time come last."""
    return matching_calls(df, number).orderBy(F.desc_nulls_last("ts"), "call_id")


def _mean_confidence():
    """Mean of the known scores, cut to 12 digits.

    Sums of doubles depend on the order in which tasks deliver them; without the
    cut, a mean at the limit of two levels would change sides from run to run.
    """
    return F.round(F.avg("confidence_score"), 12)


def risk_info(history: DataFrame) -> DataFrame:
    """One row: clamped mean confidence, its level and the number of calls."""
    mean = history.agg(_mean_confidence().alias("mean"), F.count(F.lit(1)).alias("history_count"))
    return mean.select(
        clamp_score(F.col("mean")).alias("confidence_score"), risk_level(F.col("mean")).alias("risk_level"), "history_count"
    )


def number_risk(df: DataFrame) -> DataFrame:
    """The risk of every number at once."""
    mean = (
        df.filter(F.col("caller_number").isNotNull())
        .groupBy("caller_number")
        .agg(_mean_confidence().alias("mean"), F.count(F.lit(1)).alias("history_count"))
    )
    return mean.select(
        "caller_number",
        clamp_score(F.col("mean")).alias("confidence_score"),
        risk_level(F.col("mean")).alias("risk_level"),
        "history_count",
    )


def _most_common(history: DataFrame, column: str) -> DataFrame:
    """The most common value of a column, the smaller on a tie; values are counted before they are compared."""
    counts = history.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min_by(column, F.struct(-F.col("n"), F.col(column))))


def history_summary(history: DataFrame) -> DataFrame:
    """Calls, most common label and channel (the smaller on a tie) and mean duration, one row."""
    return history.agg(
        F.count(F.lit(1)).alias("calls"), F.round(F.avg("duration_sec"), 1).alias("mean_duration_sec")
    ).select(
        "calls",
        _most_common(history, "label_5way").scalar().alias("top_label"),
        _most_common(history, "channel").scalar().alias("top_channel"),
        "mean_duration_sec",
    )
