"""Score call files as they arrive, with a saved model and its prefix counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ringwatch.operators import features as feat
from ringwatch.operators.cleaning import clean_categories
from ringwatch.operators.models import Fitted, score_calls
from ringwatch.schema import CALLS
from ringwatch.sources.calls import with_parsed_time

KEPT = ("call_id", "caller_number", "ts")


def live_features(calls: DataFrame, counts: DataFrame) -> DataFrame:
    """The features a call has by itself, plus the prefix count known from training."""
    timed = feat.add_temporal_features(clean_categories(with_parsed_time(calls)))
    return feat.build_features(timed, keep=KEPT, counts=counts)


def read_call_stream(spark: SparkSession, folder: str, source: str = "parquet", **options) -> DataFrame:
    """A stream over call files; ``maxFilesPerTrigger`` and the like go into ``options``."""
    reader = spark.readStream.schema(CALLS).format(source).options(**options)
    if source == "csv":
        reader = reader.option("header", True).option("escape", '"')
    return reader.load(folder)


def score_stream(calls: DataFrame, fitted: Fitted, counts: DataFrame) -> DataFrame:
    """Class, probability, confidence and band per arriving call; no state is kept."""
    return score_calls(live_features(calls, counts), fitted, keep=KEPT)


def write_scores(scores: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Score everything that is there, append it once, and stop."""
    return (
        scores.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def drop_repeated_calls(calls: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop exact repeats that arrive within ``delay``; state is bounded by the watermark.

    The event time must be a ``timestamp``, so the wall time is cast in the
    session's zone; it only bounds the state and is not put out.
    """
    columns = calls.columns
    timed = with_parsed_time(calls)
    timed = timed.withColumn("event_time", timed["ts"].cast("timestamp")).drop("ts")
    return timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(columns).select(*columns)
