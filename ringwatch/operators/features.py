"""The feature matrix: calendar, frequency and category features, split, scaling, filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringwatch.functions import times
from ringwatch.functions.texts import number_prefix
from ringwatch.operators.keyed import MOST_BROADCAST_ROWS, attach_bounded, attach_per_key
from ringwatch.operators.ordered import median_values, row_numbers, running_totals
from ringwatch.schema import ACTION_FLAGS, IDENTIFIER_COLUMNS, LEAK_COLUMNS, MAX_RATE_GAP_PP, PREFIX_DIGITS, TEST_SHARE

PREFIX = "caller_number_prefix"
PREFIX_FREQ = "caller_number_prefix_freq"


def add_temporal_features(df: DataFrame) -> DataFrame:
    """hour, weekday (Monday = 0) and two flags; needs ``ts``, without which the flags are False."""
    ts = F.col("ts")
    return df.withColumns(
        {
            "hour": times.hour_of(ts),
            "weekday": times.weekday_of(ts),
            "is_weekend": times.is_weekend(ts),
            "is_business_hours": times.is_business_hours(ts),
        }
    )


def add_temporal_floats(df: DataFrame) -> DataFrame:
    """The same as doubles for correlations, and the time to the next action in seconds."""
    return add_temporal_features(df).withColumns(
        {
            **{c: F.col(c).cast("double") for c in ("hour", "weekday", "is_weekend", "is_business_hours")},
            "time_to_next_action_sec": F.col("time_to_next_action_min") * 60,
        }
    )


def prefix_counts(df: DataFrame, length: int = PREFIX_DIGITS) -> DataFrame:
    """Calls per number prefix: at most 10**length rows (and the shorter ones), however many calls."""
    return (
        df.filter(F.col("caller_number").isNotNull())
        .groupBy(number_prefix(F.col("caller_number"), length).alias(PREFIX))
        .agg(F.count(F.lit(1)).alias(PREFIX_FREQ))
    )


def add_prefix_frequency(
    df: DataFrame, counts: DataFrame | None = None, length: int = PREFIX_DIGITS
) -> DataFrame:
    """How many calls share the caller's prefix, counted in ``df`` or taken from ``counts``.

    With counts of the training rows, a prefix they lack gets null. There are not more
    prefixes than numbers of up to ``length`` digits; a table that is bounded so may be
    broadcast, any other is joined by key.
    """
    table = prefix_counts(df, length) if counts is None else counts
    prefixed = df.withColumn(PREFIX, number_prefix(F.col("caller_number"), length))
    most = sum(10**digits for digits in range(length + 1))
    if most <= MOST_BROADCAST_ROWS:
        return attach_bounded(prefixed, table, PREFIX, most).drop(PREFIX)
    return attach_per_key(prefixed, table, [PREFIX], PREFIX_FREQ, df.columns).drop(PREFIX)


def frequency_encode(df: DataFrame, column: str) -> DataFrame:
    """Replace any ``column`` by its per-value count ``<column>_freq``; null stays null."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(f"{column}_freq"))
    return attach_per_key(df, counts, [column], f"{column}_freq", df.columns).drop(column)


def one_hot_channel(df: DataFrame) -> DataFrame:
    """Indicators of Mobile and VoIP; the first level, Landline, and null are all zero."""
    return df.withColumns(
        {
            f"channel_{level}": F.coalesce(F.col("channel") == level, F.lit(False)).cast("int")
            for level in ("Mobile", "VoIP")
        }
    ).drop("channel")


def drop_non_features(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop identifiers, text, the label and the score that gives the label away."""
    return df.drop(*[c for c in (*IDENTIFIER_COLUMNS, *LEAK_COLUMNS) if c not in keep])


def build_features(df: DataFrame, keep: Sequence[str] = (), counts: DataFrame | None = None) -> DataFrame:
    """Prefix frequency, channel indicators, then only feature columns."""
    return drop_non_features(one_hot_channel(add_prefix_frequency(df, counts)), keep)


# --- Split -----------------------------------------------------------------

_LAST = "timestamp_ntz'9999-12-31 23:59:59'"


def _time_key():
    # Calls without a time come last.
    return F.coalesce(F.col("ts"), F.expr(_LAST))


def cut_key(df: DataFrame, share: float) -> tuple[str, str] | None:
    """The (time, call_id) of the last of the first ``share`` of rows by time and call_id.

    Calls are counted per time before sorting; only the calls at the very time of
    the cut are then numbered, to break the tie. The time is given as ISO text,
    which no session time zone can shift.
    """
    per_time = df.groupBy(_time_key().alias("at")).agg(F.count(F.lit(1)).alias("n"))
    placed = running_totals(per_time, ["at"], ["n"])
    wanted = F.floor(placed.agg(F.sum("n")).scalar() * F.lit(share))
    cut = (
        placed.filter((F.col("n_before") < wanted) & (F.col("n_before") + F.col("n") >= wanted))
        .select(F.col("at").cast("string").alias("at"), "n", (wanted - F.col("n_before")).alias("taken"))
        .first()
    )
    if cut is None:
        return None
    ties = df.filter(_time_key() == F.lit(cut["at"]).cast("timestamp_ntz")).select("call_id")
    if cut["taken"] == cut["n"]:
        last = ties.agg(F.max("call_id"))
    elif cut["taken"] == 1:
        last = ties.agg(F.min("call_id"))
    else:
        last = row_numbers(ties, ["call_id"]).filter(F.col("row_no") == cut["taken"]).select("call_id")
    return cut["at"], last.first()[0]


def add_time_split(df: DataFrame, test_share: float = TEST_SHARE) -> DataFrame:
    """Add ``split``: 'train' for the earliest rows, 'test' for the rest.

    Exactly ``int(n * (1 - test_share))`` rows train if call_id is unique, as it is
    after deduplication. The result is a plain comparison with the key of the cut.
    """
    cut = cut_key(df, 1 - test_share)
    if cut is None:
        return df.withColumn("split", F.lit("test"))
    at = F.lit(cut[0]).cast("timestamp_ntz")
    early = (_time_key() < at) | ((_time_key() == at) & (F.col("call_id") <= cut[1]))
    return df.withColumn("split", F.when(early, "train").otherwise("test"))


def split_drift(df: DataFrame, tolerance: float = MAX_RATE_GAP_PP) -> DataFrame:
    """Fraud rates of both parts and their gap in percentage points."""
    rates = df.agg(
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "test").alias("n_test"),
        F.avg(F.when(F.col("split") == "train", F.col("is_fraud"))).alias("train_rate"),
        F.avg(F.when(F.col("split") == "test", F.col("is_fraud"))).alias("test_rate"),
    )
    gap = F.abs(F.col("train_rate") - F.col("test_rate")) * 100
    return rates.withColumns({"gap_pp": gap, "within_tolerance": gap <= tolerance})


def stratified_split(df: DataFrame, share: float = TEST_SHARE, by: str = "is_fraud") -> DataFrame:
    """Add ``split``: an exact ``share`` of each class, rounded up, is 'validation'.

    Rows are taken in the order of the MD5 of their call_id, for ids rise with time. Only
    class, hash and id are sorted; the result is a plain comparison with the last
    validation call of each class.
    """
    order = F.md5(F.col("call_id"))
    numbered = row_numbers(df.select(by, "call_id", order.alias("order")), [by, "order", "call_id"])
    classes = numbered.groupBy(by).agg(F.min("row_no").alias("start"), F.count(F.lit(1)).alias("n"))
    last = F.col("row_no") == F.col("start") + F.ceil(F.col("n") * share) - 1
    # One row per class of the target on either side of this broadcast and collect.
    cuts = numbered.join(F.broadcast(classes), by).filter(last).select(by, "order", "call_id").collect()
    held = F.lit(False)
    for cut in cuts:
        before = (order < cut["order"]) | ((order == cut["order"]) & (F.col("call_id") <= cut["call_id"]))
        held = held | ((F.col(by) == cut[by]) & before)
    return df.withColumn("split", F.when(held, "validation").otherwise("train"))


# --- Scaling and filling ---------------------------------------------------


def columns_to_scale(df: DataFrame, target: str = "is_fraud", not_features: Sequence[str] = ()) -> list[str]:
    """Numeric columns that are neither the target, nor flags, nor 0/1 indicators."""
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    skipped = {target, *not_features}
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, numeric) and f.name not in skipped and not f.name.startswith("channel_")
    ]


def fit_scaling(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; nulls ignored, a constant column divides by 1."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in columns}


def scale(df: DataFrame, fitted: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in fitted.items()})


def fill_with(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Fill nulls of numeric columns, which become doubles, so no value is cut."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in values.items() if v is not None}
    )


def impute_train_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill both parts of a split with the medians of its training part."""
    return fill_with(df, median_values(df.filter(F.col("split") == "train"), columns))


def impute_documented(df: DataFrame) -> DataFrame:
    """Medians for numbers, 'unknown' for channel and text, False for action flags."""
    medians = median_values(df, ["duration_sec", "manual_severity", "time_to_next_action_min"])
    return fill_with(df, medians).fillna(
        {"channel": "unknown", "complaint_text": "unknown", **{c: False for c in ACTION_FLAGS}}
    )


def class_weights(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Balanced weight per class: n / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = W.partitionBy()  # one row per class
    return counts.withColumn(
        "weight", F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))
    )
