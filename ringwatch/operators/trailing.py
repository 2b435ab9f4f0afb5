"""What each number did before a call: trailing counts without sliding windows.

A sliding window by caller puts all calls of a number into one task and builds a
set per row. Here every call raises a level for the next hours and lowers it
again when it leaves the window; the value before a call is the running level
just before its time. The events of all callers lie in one sorted table, cut
into even slices, so the calls of a busy number are spread over many tasks.
Every raise has its fall, so each caller starts from level 0 by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringwatch.functions.texts import keyword_score
from ringwatch.functions.times import week_number
from ringwatch.operators.keyed import attach_per_key
from ringwatch.operators.ordered import running_totals

CALLS_24H = "calls_from_number_last_24h"
VICTIMS_7D = "distinct_victims_last_7d"
MEAN_DURATION = "mean_call_duration_per_number"
KEYWORD_SCORE = "complaint_keyword_score"


def _hours_later(ts: Column, hours: int) -> Column:
    return F.timestamp_add("HOUR", F.lit(hours), ts)


def _call_levels(df: DataFrame, hours: int) -> DataFrame:
    """+n right after a time with n calls, -n when they are ``hours`` old."""
    cells = df.groupBy("caller_number", "ts").agg(F.count(F.lit(1)).alias("n"))
    return cells.select(
        "caller_number",
        F.inline(
            F.array(
                F.struct(F.col("ts").alias("at"), F.col("n").alias("calls"), F.col("n").alias("here")),
                F.struct(
                    _hours_later(F.col("ts"), hours).alias("at"),
                    (-F.col("n")).alias("calls"),
                    F.lit(0).cast("bigint").alias("here"),
                ),
            )
        ),
    )


def _victim_levels(df: DataFrame) -> DataFrame:
    """+1 when a number starts to have a victim in its last seven days, -1 when it ends.

    All calls to one victim within a seven-day block keep that victim in view
    without a gap, from the first call to seven days after the last. So only the
    first and last call of a block matter, and a pair has one row per block.
    """
    blocks = (
        df.filter(F.col("called_number").isNotNull())
        .groupBy("caller_number", "called_number", week_number(F.col("ts")).alias("week"))
        .agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    )
    pair = W.partitionBy("caller_number", "called_number").orderBy("week")
    ends = _hours_later(F.col("last"), 7 * 24)
    seen = blocks.withColumns(
        {"ends": ends, "ends_before": F.lag(ends).over(pair), "starts_next": F.lead("first").over(pair)}
    )
    starts_new = F.col("ends_before").isNull() | (F.col("first") > F.col("ends_before"))
    stops = F.col("starts_next").isNull() | (F.col("starts_next") > F.col("ends"))
    return seen.select(
        "caller_number",
        F.inline(
            F.array(
                F.struct(F.when(starts_new, F.col("first")).alias("at"), F.lit(1).cast("bigint").alias("victims")),
                F.struct(F.when(stops, F.col("ends")).alias("at"), F.lit(-1).cast("bigint").alias("victims")),
            )
        ),
    ).filter(F.col("at").isNotNull())


def trailing_levels(df: DataFrame) -> DataFrame:
    """Per caller and call time: calls in the 24 hours and victims in the 7 days before.

    The windows are [t-24h, t) and [t-7d, t): calls at t itself do not count; ``here``
    says how many there are.
    """
    placed = df.filter(F.col("caller_number").isNotNull() & F.col("ts").isNotNull())
    zero = F.lit(0).cast("bigint")
    calls = _call_levels(placed, 24).withColumn("victims", zero)
    victims = _victim_levels(placed).withColumns({"calls": zero, "here": zero})
    amounts = ["calls", "victims", "here"]
    changes = calls.unionByName(victims).groupBy("caller_number", "at").agg(*[F.sum(a).alias(a) for a in amounts])
    levels = running_totals(changes, ["caller_number", "at"], ["calls", "victims"])
    return levels.filter(F.col("here") > 0).select(
        "caller_number",
        F.col("at").alias("ts"),
        F.col("calls_before").alias(CALLS_24H),
        F.col("victims_before").alias(VICTIMS_7D),
        "here",
    )


def mean_durations(df: DataFrame) -> DataFrame:
    """Mean duration and row count per known caller."""
    return (
        df.filter(F.col("caller_number").isNotNull())
        .groupBy("caller_number")
        .agg(F.avg("duration_sec").alias(MEAN_DURATION), F.count(F.lit(1)).alias("__n"))
    )


def add_mean_duration(df: DataFrame) -> DataFrame:
    """The caller's mean duration over the whole table on each of its rows."""
    return attach_per_key(df, mean_durations(df), ["caller_number"], "__n", df.columns).drop("__n")


def add_trailing_features(df: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Add the four behavioral features; needs ``ts``.

    Mean durations come from ``reference`` if given (such as the training rows),
    else from ``df`` itself. Only (caller, time) rows meet the per-caller table;
    the full rows are moved once, by caller and time.
    """
    per_caller = mean_durations(df if reference is None else reference)
    levels = trailing_levels(df)
    caller, time = ["caller_number"], ["caller_number", "ts"]
    per_time = attach_per_key(levels, per_caller, caller, "__n", time).drop("__n")
    known = df.filter(F.col("caller_number").isNotNull() & F.col("ts").isNotNull())
    timed = attach_per_key(known, per_time, time, "here", df.columns, levels.select(*time, "here")).drop("here")
    # Without caller or time there is nothing to look back from.
    rest = df.filter(F.col("caller_number").isNull() | F.col("ts").isNull())
    untimed = attach_per_key(rest, per_caller, caller, "__n", df.columns).drop("__n").withColumns(
        {CALLS_24H: F.lit(0).cast("bigint"), VICTIMS_7D: F.lit(0).cast("bigint")}
    )
    both = timed.unionByName(untimed)
    return both.select(
        *df.columns, CALLS_24H, VICTIMS_7D, MEAN_DURATION, keyword_score(F.col("complaint_text")).alias(KEYWORD_SCORE)
    )
