"""Timestamp normalisation and calendar features.

Values are ``timestamp_ntz`` wall times in Tallinn. Nothing here reads the
session time zone, so every session gets the same answer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringwatch.schema import TIME_ZONE, WEEKDAYS

_PLAIN = r"^\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}(:\d{1,2})?)?$"
_OFFSET = r"(:\d{2}|\.\d+|T\d{2}) ?(Z|[+-]\d{2}:?\d{2}|[+-]\d{2})$"

# Local spellings -> ISO order. Dates are day-first after a slash and month-first
# after a short dash; a part above 12 cannot be the month, so such a date is read
# the other way round. Years of two digits from 69 on belong to the last century.
_KELL = [(r"^(\d{1,2})\.(\d{1,2})\.(\d{4}) kell (\d{1,2}:\d{1,2})$", "$3-$2-$1 $4")]
_SLASH = [
    (r"^(\d{1,2})/(1[3-9]|[23]\d)/(\d{4})", "$3-$1-$2"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$2-$1"),
]
_SHORT_DASH = [
    (r"^(\d{1,2}-\d{1,2})-(69|[7-9]\d)(?!\d)", "$1-19$2"),
    (r"^(\d{1,2}-\d{1,2})-(\d{2})(?!\d)", "$1-20$2"),
    (r"^(1[3-9]|[23]\d)-(\d{1,2})-(\d{4})", "$3-$2-$1"),
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})", "$3-$1-$2"),
]
# The result has whole seconds, and an offset follows the clock without a space.
_TAIL = [(r"(:\d{2})\.\d+", "$1"), (r" (Z|[+-]\d{2}:?\d{2})$", "$1")]


def _rewrite(text: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, form in steps:
        text = F.regexp_replace(text, pattern, form)
    return text


def _iso(text: Column) -> Column:
    ordered = (
        F.when(text.contains("kell"), _rewrite(text, _KELL))
        .when(text.contains("/"), _rewrite(text, _SLASH))
        .when(text.rlike(r"^\d{1,3}-"), _rewrite(text, _SHORT_DASH))
        .otherwise(text)
    )
    return _rewrite(ordered, _TAIL)


def _wall_time(seconds: Column) -> Column:
    """Epoch seconds as Tallinn wall time, by way of UTC wall time."""
    utc = F.timestamp_add("SECOND", seconds, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))
    return F.convert_timezone(F.lit("UTC"), F.lit(TIME_ZONE), utc)


def normalize_timestamp(raw: Column) -> Column:
    """Any of the six known spellings -> Tallinn wall time, null if unreadable.

    All digits are epoch seconds, and a text with an offset is an instant too; both
    are converted. ``dd.MM.yyyy kell HH:mm`` is the Estonian form; slashes are
    day-first; a short first dash part is month-first; the rest is ISO. The common
    form comes first and costs one match and one cast.
    """
    text = F.trim(raw)
    return (
        F.when(text.rlike(_PLAIN), text.try_cast("timestamp_ntz"))
        .when(text.rlike(r"^\d{1,10}$"), _wall_time(text.try_cast("bigint")))
        .when(text.rlike(_OFFSET), _wall_time(F.unix_seconds(_iso(text).try_cast("timestamp"))))
        .otherwise(_iso(text).try_cast("timestamp_ntz"))
    )


def normalize_timestamp_strict(raw: Column) -> Column:
    """As :func:`normalize_timestamp`, but unreadable text fails the job; null stays null."""
    parsed = normalize_timestamp(raw)
    return F.when(raw.isNull() | parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit("Could not parse timestamp: "), raw))
    )


def floor_minute(ts: Column) -> Column:
    """Start of the minute of a whole-second wall time."""
    return F.timestamp_add("SECOND", -F.second(ts), ts)


def week_number(ts: Column) -> Column:
    """Number of the seven-day block that holds ``ts``."""
    return F.floor(F.date_diff(F.to_date(ts), F.lit("0001-01-01").cast("date")) / 7)


def hour_of(ts: Column) -> Column:
    return F.hour(ts)


def weekday_of(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def weekday_name(ts: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.weekday(ts) + 1)


def is_weekend(ts: Column) -> Column:
    """False without a time."""
    return F.coalesce(F.weekday(ts) >= 5, F.lit(False))


def is_business_hours(ts: Column) -> Column:
    """Monday to Friday, from 9:00 until before 17:00; False without a time."""
    hour = F.hour(ts)
    return F.coalesce((hour >= 9) & (hour < 17) & (F.weekday(ts) < 5), F.lit(False))
