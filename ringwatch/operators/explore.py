"""Profiles of callers, labels, keywords, actions and hours."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.functions import risk, times
from ringwatch.functions.texts import canonical_label, keyword_flags, keyword_score
from ringwatch.operators.cleaning import first_present
from ringwatch.schema import (
    ACTION_FLAGS,
    CANONICAL_FRAUD_LABELS,
    FRAUD_LABELS,
    KEYWORD_PATTERNS,
    LABELS,
    WEEKDAYS,
)

# --- Callers ---------------------------------------------------------------


def caller_profile(df: DataFrame) -> DataFrame:
    """Volume, distinct victims, fraud share and mean duration per known caller.

    Spark first combines rows per (caller, victim), so a busy caller is spread
    over its victims before the counts meet.
    """
    return (
        df.filter(F.col("caller_number").isNotNull())
        .withColumn("__fraud", risk.fraud_flag(F.col("label_5way")))
        .groupBy("caller_number")
        .agg(
            F.count("call_id").alias("total_calls"),
            F.countDistinct("called_number").alias("distinct_victims"),
            F.avg("__fraud").alias("fraud_rate"),
            F.avg("duration_sec").alias("avg_duration_sec"),
        )
    )


# --- Fixed values: size and noise limit of the published ranking. ---
TOP_CALLERS = 20
MIN_CALLS = 20


def top_suspicious(profile: DataFrame, n: int = TOP_CALLERS, min_calls: int = MIN_CALLS) -> DataFrame:
    """The ``n`` callers with the highest fraud rate among those with enough calls."""
    return (
        profile.filter(F.col("total_calls") >= min_calls)
        .orderBy(F.desc("fraud_rate"), F.desc("total_calls"), F.asc("caller_number"))
        .limit(n)
    )


def with_bands(profile: DataFrame) -> DataFrame:
    rate = F.col("fraud_rate")
    return profile.withColumns(
        {"band": risk.caller_band(rate), "pattern": risk.caller_pattern(rate, F.col("total_calls"))}
    )


def pattern_summary(profile: DataFrame) -> DataFrame:
    """Numbers, calls and summed victims per caller pattern."""
    return (
        with_bands(profile)
        .groupBy("pattern")
        .agg(
            F.count(F.lit(1)).alias("numbers"),
            F.sum("total_calls").alias("calls"),
            F.sum("distinct_victims").alias("victims"),
        )
    )


def caller_counts(profile: DataFrame, min_calls: int = MIN_CALLS) -> DataFrame:
    """How many callers there are, and how many have enough calls to be ranked."""
    return profile.agg(
        F.count(F.lit(1)).alias("callers"),
        F.count_if(F.col("total_calls") >= min_calls).alias("ranked_callers"),
    )


NUMBER_COLUMNS = ["caller_number", "phone_number", "number", "caller", "from_number"]


def top_numbers(df: DataFrame, n: int = 10) -> DataFrame:
    """Numbers of labelled calls by fraud rate, then fraud cases, then calls; no minimum."""
    number = first_present(df, NUMBER_COLUMNS)
    return (
        df.filter(F.col(number).isNotNull())
        .groupBy(F.col(number).alias("number"))
        .agg(
            F.count(F.lit(1)).alias("total_calls"),
            F.sum("is_fraud").alias("fraud_cases"),
            F.avg("is_fraud").alias("fraud_rate"),
        )
        .orderBy(F.desc("fraud_rate"), F.desc("fraud_cases"), F.desc("total_calls"), F.asc("number"))
        .limit(n)
    )


def top_volume(df: DataFrame, n: int = 10) -> DataFrame:
    """The busiest callers with their fraud rate by canonical label."""
    fraud = risk.fraud_flag(canonical_label(F.col("label_5way")), CANONICAL_FRAUD_LABELS)
    return (
        df.filter(F.col("caller_number").isNotNull())
        .groupBy("caller_number")
        .agg(F.count("call_id").alias("calls"), F.avg(fraud).alias("fraud_rate"))
        .orderBy(F.desc("calls"), F.asc("caller_number"))
        .limit(n)
    )


# --- Labels, channels, actions ---------------------------------------------


def value_counts(df: DataFrame, column: str | Column, name: str = "value") -> DataFrame:
    """Rows per value, null included."""
    value = F.col(column) if isinstance(column, str) else column
    return df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def behavior_share(df: DataFrame, label: str | Column = "label_5way") -> DataFrame:
    """Share of calls followed by each action, per label."""
    key = F.col(label) if isinstance(label, str) else label
    return (
        df.filter(key.isNotNull())
        .groupBy(key.alias("label"))
        .agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in ACTION_FLAGS])
    )


def subsequent_events(df: DataFrame) -> DataFrame:
    """Share of calls followed within the hour by a login, a transfer or a new payee, per label."""
    minutes = F.col("time_to_next_action_min")
    actions = {"login": "login_after_call", "transfer": "transfer_after_call", "new_payee": "new_payee_after_call"}
    return (
        df.filter(F.col("label_5way").isNotNull())
        .groupBy("label_5way")
        .agg(
            *[
                F.avg(risk.acted_within(F.col(flag), minutes).cast("double")).alias(f"{name}_within_1h")
                for name, flag in actions.items()
            ]
        )
    )


# --- Hours -----------------------------------------------------------------


def call_heatmap(df: DataFrame, label: str = "Confirmed_Fraud") -> DataFrame:
    """Calls of one label by weekday and hour; needs ``ts``, rows without it are left out."""
    return (
        df.filter((F.col("label_5way") == label) & F.col("ts").isNotNull())
        .groupBy(times.weekday_name(F.col("ts")).alias("day_of_week"), F.hour("ts").alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def call_heatmap_pivot(df: DataFrame, label: str = "Confirmed_Fraud") -> DataFrame:
    """The heat map with one row per weekday, Monday first, and one column per hour."""
    days = df.sparkSession.createDataFrame(list(enumerate(WEEKDAYS)), "day_no int, day_of_week string")
    grid = call_heatmap(df, label).groupBy("day_of_week").pivot("hour", list(range(24))).agg(F.sum("n"))
    grid = grid.withColumnsRenamed({str(h): f"h{h:02d}" for h in range(24)})
    # At most seven rows on either side.
    return F.broadcast(days).join(grid, "day_of_week", "left").orderBy("day_no")


def fraud_by_hour(df: DataFrame) -> DataFrame:
    """Fraud rate of labelled calls by hour."""
    return df.filter(F.col("hour").isNotNull()).groupBy("hour").agg(F.avg("is_fraud").alias("fraud_rate"))


def feature_correlations(df: DataFrame, features: Sequence[str], target: Column) -> DataFrame:
    """Pearson correlation of each feature with ``target`` over the rows that have both.

    A constant feature has no correlation: null. One pass for all features.
    """
    y = target.cast("double")

    def corr(name: str) -> Column:
        x = F.col(name).cast("double")
        paired = F.when(x.isNotNull(), y)
        spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(paired)
        return F.try_divide(F.covar_pop(x, y), F.nullif(spread, F.lit(0.0)))

    wide = df.agg(*[corr(name).alias(name) for name in features])
    return wide.unpivot([], list(features), "feature", "correlation")


# --- Complaint keywords ----------------------------------------------------


def with_keyword_flags(df: DataFrame, patterns: Mapping[str, str] = KEYWORD_PATTERNS) -> DataFrame:
    return df.withColumns(keyword_flags(F.col("complaint_text"), patterns))


def with_keyword_score(df: DataFrame) -> DataFrame:
    return df.withColumn("complaint_keyword_score", keyword_score(F.col("complaint_text")))


def keyword_counts(df: DataFrame, patterns: Mapping[str, str] = KEYWORD_PATTERNS) -> DataFrame:
    """Per label, in fixed order: its rows, with or without text, and the rows with each keyword."""
    labels = df.sparkSession.createDataFrame(list(enumerate(LABELS)), "label_no int, label string")
    flags = keyword_flags(F.col("complaint_text"), patterns)
    counted = (
        df.filter(F.col("label_5way").isin(LABELS))
        .groupBy(F.col("label_5way").alias("label"))
        .agg(F.count(F.lit(1)).alias("n_complaints"), *[F.count_if(flag).alias(name) for name, flag in flags.items()])
    )
    # Five rows on either side.
    return (
        F.broadcast(labels)
        .join(counted, "label", "left")
        .fillna(0, subset=["n_complaints", *patterns])
        .orderBy("label_no")
    )


def keyword_shares(counts: DataFrame, patterns: Mapping[str, str] = KEYWORD_PATTERNS) -> DataFrame:
    """Share of each label's rows that hold each keyword; 0 for a label without rows."""
    return counts.select(
        "label",
        *[
            F.coalesce(F.try_divide(F.col(f"`{k}`"), F.col("n_complaints")), F.lit(0.0)).alias(k)
            for k in patterns
        ],
    )


def keyword_lift(
    counts: DataFrame, patterns: Mapping[str, str] = KEYWORD_PATTERNS, label: str = "Confirmed_Fraud"
) -> DataFrame:
    """Keyword share in ``label`` against all others, and their ratio; infinite if others lack it."""
    long = counts.withColumnsRenamed({"n_complaints": "rows"}).unpivot(
        ["label", "rows"], [f"`{k}`" for k in patterns], "keyword", "hits"
    )
    own = F.col("label") == label

    def share(mine: Column) -> Column:
        hits = F.sum(F.when(mine, F.col("hits")).otherwise(0))
        rows = F.sum(F.when(mine, F.col("rows")).otherwise(0))
        return F.coalesce(F.try_divide(hits, rows), F.lit(0.0))

    shares = long.groupBy("keyword").agg(share(own).alias("f"), share(~own).alias("o"))
    lift = F.when(F.col("o") == 0, F.lit(float("inf"))).otherwise(F.round(F.try_divide(F.col("f"), F.col("o")), 2))
    return shares.select(
        "keyword", F.round("f", 3).alias("fraud_share"), F.round("o", 3).alias("other_share"), lift.alias("lift")
    ).orderBy(F.desc("lift"), F.asc("keyword"))


# --- Rankings and metadata -------------------------------------------------


def top_k(df: DataFrame, k: int, column: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest ``column``; nulls last."""
    return df.orderBy(F.desc_nulls_last(column), *tie_break).limit(k)


def top_risk_calls(df: DataFrame, k: int = 15) -> DataFrame:
    return top_k(df, k, "confidence_score", ["call_id"]).select(
        "call_id", "ts", "caller_number", "called_number", "label_5way", "channel", "confidence_score"
    )


def filter_options(df: DataFrame) -> DataFrame:
    """Sorted distinct labels and channels, to choose filters from; one pass over the calls."""
    pairs = df.select(
        F.inline(
            F.array(
                F.struct(F.lit("label").alias("field"), F.col("label_5way").alias("value")),
                F.struct(F.lit("channel").alias("field"), F.col("channel").alias("value")),
            )
        )
    )
    return pairs.filter(F.col("value").isNotNull()).distinct().orderBy("field", "value")


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min(F.to_date("ts")).alias("first_date"), F.max(F.to_date("ts")).alias("last_date"))


def fraud_label_share(df: DataFrame) -> DataFrame:
    return df.agg(F.avg(risk.fraud_flag(F.col("label_5way"), FRAUD_LABELS)).alias("fraud_rate"))
