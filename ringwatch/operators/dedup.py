"""Exact and near duplicates.

Both passes combine rows before the shuffle, so a call that was copied into a
third of the table arrives as a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringwatch.functions.times import floor_minute
from ringwatch.schema import NEAR_DUPLICATE_SECONDS

_KEY = ["caller_number", "called_number", "__minute"]


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One of each set of fully equal rows; null equals null."""
    return df.dropDuplicates()


def _band(duration: Column, tolerance: float) -> Column:
    """Durations of one band differ by less than the tolerance, so only its first can stay.

    Half the tolerance is the width, which leaves room for rounding in the division.
    """
    return F.floor(duration / (tolerance / 2)) if tolerance > 0 else duration


def _with_key(df: DataFrame, tolerance: float) -> DataFrame:
    return df.withColumns(
        {"__minute": floor_minute(F.col("ts")), "__band": _band(F.col("duration_sec"), tolerance)}
    )


def _first_of_band_stays(tolerance: float, *alone: str) -> Column:
    """Whether a band's shortest call lies beyond the tolerance of the band before.

    A key has as many bands as the span of its durations holds tolerances, so
    this window sees few rows per key even if the key holds many calls.
    """
    previous = F.lag("__longest").over(W.partitionBy(*_KEY, *alone).orderBy("__band"))
    return previous.isNull() | (F.col("__shortest") - previous > tolerance)


def drop_near_duplicates(df: DataFrame, tolerance: float = NEAR_DUPLICATE_SECONDS) -> DataFrame:
    """Drop a call whose duration is within ``tolerance`` of the next shorter one.

    Calls are compared within (caller, called, minute), where null equals null.
    The next shorter call counts even if it is dropped itself. Equal durations
    keep the lowest call_id. A call without duration is always kept. Needs ``ts``,
    and distinct rows: run the exact pass first.
    """
    columns = df.columns
    untimed = F.col("duration_sec").isNull()
    # call_id right after the duration settles ties; the other columns make the order total.
    ordered = ["duration_sec", "call_id", *[c for c in columns if c not in ("duration_sec", "call_id")]]
    # A call without duration is a group of its own: rows are distinct, so id and hash tell them apart.
    bands = (
        _with_key(df, tolerance)
        .withColumn("__alone", F.when(untimed, F.struct("call_id", F.xxhash64(*columns))))
        .groupBy(*_KEY, "__alone", "__band")
        .agg(
            F.min(F.struct(*ordered)).alias("__first"),
            F.min("duration_sec").alias("__shortest"),
            F.max("duration_sec").alias("__longest"),
        )
    )
    stays = F.col("__shortest").isNull() | _first_of_band_stays(tolerance, "__alone")
    return bands.withColumn("__stays", stays).filter("__stays").select("__first.*").select(*columns)


def dedup(df: DataFrame, tolerance: float = NEAR_DUPLICATE_SECONDS) -> DataFrame:
    """Exact duplicates first, then near duplicates of what is left."""
    return drop_near_duplicates(drop_exact_duplicates(df), tolerance)


def dedup_report(df: DataFrame, tolerance: float = NEAR_DUPLICATE_SECONDS) -> DataFrame:
    """One row of disjoint counters: before, exact, near, near groups, after."""
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    bands = _with_key(distinct, tolerance).groupBy(*_KEY, "__band").agg(
        F.sum("__copies").alias("__before"),
        F.count(F.lit(1)).alias("__distinct"),
        F.min("duration_sec").alias("__shortest"),
        F.max("duration_sec").alias("__longest"),
    )
    # Bands sort nulls first; the rows without duration are never compared.
    stays = F.when(F.col("__band").isNull(), F.col("__distinct")).otherwise(
        _first_of_band_stays(tolerance).cast("bigint")
    )
    groups = bands.withColumn("__kept", stays).groupBy(*_KEY).agg(
        F.sum("__before").alias("__before"),
        F.sum("__distinct").alias("__distinct"),
        F.sum("__kept").alias("__kept"),
    )
    return groups.agg(
        F.sum("__before").alias("rows_before"),
        (F.sum("__before") - F.sum("__distinct")).alias("exact_duplicates"),
        (F.sum("__distinct") - F.sum("__kept")).alias("near_duplicates"),
        F.sum("__kept").alias("rows_after"),
        F.count_if(F.col("__distinct") > F.col("__kept")).alias("near_dup_groups"),
    )


def duplicate_key_count(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """How many rows repeat the ``key`` of another row; null equals null."""
    return df.groupBy(*key).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))
