"""Joining per-key results back to rows when a few keys hold many of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# A key is heavy if it holds more than 1/HEAVY_SHARE of all rows, so there are
# at most HEAVY_SHARE heavy keys, whatever the size of the table.
HEAVY_SHARE = 1024
# Slim rows that may be broadcast: a few dozen megabytes.
MOST_BROADCAST_ROWS = 2_000_000


def attach_per_key(
    df: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    rows: str,
    spread_by: Sequence[str],
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Left-join ``per_key`` (one row per key, ``rows`` = its row count) to ``df``.

    The rows of a heavy key go to as many tasks as its size asks for, picked by a
    hash of ``spread_by``, and its per-key row is copied to each. Only the heavy
    keys are broadcast. The hash depends on the row alone, so that a task that is
    run again after a loss sends each row to the same place. ``sizes`` may give the
    keys and row counts from a cheaper plan than ``per_key``.
    """
    keys = list(keys)
    sizes = per_key if sizes is None else sizes
    share = F.lit(HEAVY_SHARE) / sizes.agg(F.sum(rows)).scalar()
    parts_of_key = F.greatest(F.ceil(F.col(rows) * share), F.lit(1)).cast("int")
    heavy = sizes.select(*keys, parts_of_key.alias("__parts")).filter(F.col("__parts") > 1)
    # Rows without a key match nothing, but would all meet in one task.
    unknown = F.lit(False)
    for key in keys:
        unknown = unknown | F.col(key).isNull()
    parts = F.when(unknown, F.lit(HEAVY_SHARE)).otherwise(F.coalesce(F.col("__parts"), F.lit(1)))
    left = df.join(F.broadcast(heavy), keys, "left").withColumn(
        "__part", F.pmod(F.xxhash64(*spread_by), parts).cast("int")
    )
    right = per_key.withColumn("__part", F.explode(F.sequence(F.lit(0), parts_of_key - 1)))
    return left.join(right, [*keys, "__part"], "left").drop("__part", "__parts")


def attach_bounded(df: DataFrame, per_key: DataFrame, key: str, bound: int) -> DataFrame:
    """Left-join by broadcast a per-key table that has ``bound`` rows at most by its form.

    A table with more rows fails the job while it is collected for the broadcast.
    """
    if bound > MOST_BROADCAST_ROWS:
        raise ValueError(f"a table of {bound} rows is not to be broadcast")
    numbered = per_key.withColumn("__rows", F.count(F.lit(1)).over(W.partitionBy()))
    checked = numbered.filter(
        F.when(F.col("__rows") <= bound, F.lit(True)).otherwise(F.raise_error(F.lit(f"more than {bound} keys")))
    ).drop("__rows")
    return df.join(F.broadcast(checked), key, "left")
