"""Jobs over arriving calls that need what came before: trailing features, duplicates.

State by key would put all calls of a busy number into one task. Here a small table is
carried over from batch to batch: the calls that later ones may still look back to. Each
batch is worked on together with it by the distributed operators that a whole table takes, and leaves
the next one. Result and carried table are written under the number of the batch, so that a
batch that is run again after a failure replaces its own rows.

Calls must arrive in time order from batch to batch; within a batch any order will do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ringwatch.functions.times import floor_minute
from ringwatch.operators.dedup import dedup
from ringwatch.operators.trailing import add_trailing_features
from ringwatch.schema import NEAR_DUPLICATE_SECONDS
from ringwatch.session import store

#: New calls, what was carried over (none at first) -> result, what is carried on.
Step = Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame]]


def _hours_before(ts: Column, hours: int) -> Column:
    return F.timestamp_add("HOUR", F.lit(-hours), ts)


def open_calls(calls: DataFrame) -> DataFrame:
    """``caller_number, called_number, ts`` of what trailing features of later calls can still see.

    All calls of the last 24 hours before the latest call, and of each earlier pair of numbers
    within seven days its last call.
    """
    latest = calls.agg(F.max("ts")).scalar()
    seen = calls.filter(F.col("caller_number").isNotNull()).select("caller_number", "called_number", "ts")
    day, week = _hours_before(latest, 24), _hours_before(latest, 7 * 24)
    earlier = (
        seen.filter((F.col("ts") < day) & (F.col("ts") >= week) & F.col("called_number").isNotNull())
        .groupBy("caller_number", "called_number")
        .agg(F.max("ts").alias("ts"))
    )
    return seen.filter(F.col("ts") >= day).unionByName(earlier)


def trailing_step(reference: DataFrame | None = None) -> Step:
    """Add the behavioral features to each new call; needs ``ts``.

    Mean durations come from ``reference``, such as the training rows; without it from the
    calls at hand, which are then those of the batch and the carried ones.
    """

    def step(new: DataFrame, carried: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        both = new.withColumn("__new", F.lit(True))
        if carried is not None:
            both = both.unionByName(carried.withColumn("__new", F.lit(False)), allowMissingColumns=True)
        both = store(both, "carried-trailing")
        return add_trailing_features(both, reference).filter("__new").drop("__new"), open_calls(both)

    return step


def dedup_step(tolerance: float = NEAR_DUPLICATE_SECONDS) -> Step:
    """Drop exact and near duplicates; needs ``ts``.

    Calls are compared within a minute, so all of the latest minute are carried over until
    a later call arrives; :func:`close_carried` lets the last ones go. Calls without time
    are compared within their batch.
    """

    def step(new: DataFrame, carried: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        both = store(new if carried is None else new.unionByName(carried), "carried-dedup")
        minute = floor_minute(F.col("ts"))
        latest = both.agg(F.max(minute)).scalar()
        is_open = F.coalesce(minute == latest, F.lit(False))
        return dedup(both.filter(~is_open), tolerance), both.filter(is_open)

    return step


def _batch(folder: str, number: int) -> str:
    return f"{folder}/batch={number}"


def write_carried(stream: DataFrame, step: Step, folder: str, carried: str, checkpoint: str) -> StreamingQuery:
    """Run a step over everything that has arrived, batch after batch, and stop.

    ``folder`` gets the results, ``carried`` the tables that are carried over, both below the
    number of their batch; the table before the last one is no longer needed.
    """

    def run(new: DataFrame, number: int) -> None:
        spark = new.sparkSession
        before = spark.read.parquet(_batch(carried, number - 1)) if number else None
        result, after = step(new, before)
        after.write.mode("overwrite").parquet(_batch(carried, number))
        result.write.mode("overwrite").parquet(_batch(folder, number))

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def close_carried(carried: DataFrame, tolerance: float = NEAR_DUPLICATE_SECONDS) -> DataFrame:
    """What is left of the last carried table of :func:`dedup_step` when no further call will arrive."""
    return dedup(carried, tolerance)
