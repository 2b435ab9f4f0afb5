"""Calls laid out by number, so that the history of a number reads few files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.operators.lookup import matching_calls

# Sorts after every digit, so that all numbers with a prefix lie below prefix + this.
_AFTER_DIGITS = ":"


def write_by_number(df: DataFrame, path: str) -> None:
    """Write calls in ranges of caller numbers, with a Bloom filter of the numbers in each row group.

    The ranges are cut by (number, hash of the call), so that a number which made a large part of
    all calls fills several files. Beside the calls, ``ranges`` holds the first and last number of
    each file: one row per file, from one pass over the column of numbers. Numbers are digits, as
    ``load_calls`` leaves them. A call without caller is stored but no lookup finds it.
    """
    number = F.col("caller_number")
    placed = df.repartitionByRange(number, F.xxhash64("call_id")).sortWithinPartitions(number, "call_id")
    placed.write.mode("overwrite").option("parquet.bloom.filter.enabled#caller_number", "true").parquet(f"{path}/calls")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/calls")
    ranges = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(number).alias("first_number"), F.max(number).alias("last_number")
    )
    ranges.write.mode("overwrite").parquet(f"{path}/ranges")


def files_of(spark: SparkSession, path: str, number: str) -> list[str]:
    """The files that may hold calls from ``number`` or from numbers that start with it."""
    digits = re.sub(r"[^0-9]", "", number or "")
    if not digits:
        return []
    ranges = spark.read.schema("file string, first_number string, last_number string").parquet(f"{path}/ranges")
    held = (F.col("last_number") >= digits) & (F.col("first_number") < digits + _AFTER_DIGITS)
    return sorted(r["file"] for r in ranges.filter(held).select("file").collect())


def stored_matches(spark: SparkSession, path: str, number: str) -> DataFrame:
    """The rows of :func:`~ringwatch.operators.lookup.matching_calls`, from the files that can hold them alone.

    Within these files the comparisons reach the scan, whose row groups are left out by their
    range and their Bloom filter. An unknown or empty number gives no rows.
    """
    calls = spark.read.parquet(f"{path}/calls")
    files = files_of(spark, path, number)
    return matching_calls(spark.read.schema(calls.schema).parquet(*files), number) if files else calls.limit(0)
