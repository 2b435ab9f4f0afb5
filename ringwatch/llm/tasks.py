"""Running Python on batches of rows, with this package's code sent along."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from ringwatch.session import send_package

#: Rows that go to Python and back at once. Texts are long: Spark's own number makes batches of many megabytes.
BATCH_ROWS = 1000
_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def give_back_memory() -> None:
    """Hand memory that nothing uses any more back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries have no such call
        pass


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``df.mapInArrow`` with the package at hand in the tasks.

    The session's batches are made small (``BATCH_ROWS``) if they are larger; what a task
    keeps in memory goes with it.
    """
    spark = df.sparkSession
    send_package(spark)
    if not 0 < int(spark.conf.get(_ROWS_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_ROWS_SETTING, str(BATCH_ROWS))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back_memory()

    return df.mapInArrow(task, schema)


def unused_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, in any spelling of upper and lower case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def quoted(name: str) -> str:
    """A column name as it is, whatever signs are in it."""
    return "`" + name.replace("`", "``") + "`"
