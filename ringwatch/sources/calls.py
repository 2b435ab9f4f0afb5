"""Call tables on files: typed reads, partitioned writes, a normalised load."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ringwatch.functions.texts import digits_only
from ringwatch.functions.times import normalize_timestamp
from ringwatch.schema import CALLS
from ringwatch.session import store


CORRUPT = "corrupt_record"


def _csv(spark: SparkSession, schema: StructType, multi_line: bool) -> DataFrameReader:
    # All columns are parsed whatever is asked for, so that a record is damaged or not.
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("columnPruning", False)
    )


def read_calls(spark: SparkSession, path: str, source: str = "csv", multi_line: bool = False) -> DataFrame:
    """Read calls with the declared types; in CSV an empty field and NaN are null.

    A CSV record with too few or too many fields or with an unreadable value fails the job;
    :func:`corrupt_records` shows such records. ``multi_line`` admits line breaks in quoted
    text, but then a file is one task; without it they fail as broken records.
    """
    if source != "csv":
        return spark.read.schema(CALLS).format(source).load(path)
    numbers = [f.name for f in CALLS.fields if f.dataType.typeName() == "double"]
    rows = _csv(spark, CALLS, multi_line).option("mode", "FAILFAST").csv(path)
    return rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in numbers})


def corrupt_records(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The CSV records that :func:`read_calls` would fail on, as text; count them for a report."""
    schema = StructType([*CALLS.fields, StructField(CORRUPT, StringType())])
    rows = _csv(spark, schema, multi_line).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    # Kept with all columns: a reader that is asked for the record alone does not parse it.
    return store(rows.csv(path).filter(F.col(CORRUPT).isNotNull()), "corrupt-records").select(CORRUPT)


def write_calls(df: DataFrame, path: str, sink: str = "parquet", by_date: bool = False) -> None:
    """Write calls; ``by_date`` lays them out by call date, so date filters prune files.

    The rows are cut into even ranges of (date, hash of the call): a quiet day is one
    file, and a day that holds a large part of all rows becomes many.
    """
    writer = df
    if by_date:
        writer = df.withColumn("call_date", F.to_date("ts")).repartitionByRange(
            F.col("call_date"), F.xxhash64("call_id")
        )
    out = writer.write.mode("overwrite").format(sink)
    if by_date:
        out = out.partitionBy("call_date")
    if sink == "csv":
        out = out.option("header", True).option("escape", '"')
    out.save(path)


def replace_days(df: DataFrame, path: str) -> None:
    """Write ``df`` over a table that :func:`write_calls` laid out by date, in the place of the days it has.

    Files of other days are left as they are. Calls without time are a day of their own. A day
    of which ``df`` has no call is kept, so an empty ``df`` changes nothing.
    """
    dated = df.withColumn("call_date", F.to_date("ts")).repartitionByRange(F.col("call_date"), F.xxhash64("call_id"))
    out = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy("call_date").parquet(path)


def with_parsed_time(df: DataFrame) -> DataFrame:
    """Add ``ts``, the normalised time of the raw ``timestamp`` text.

    A one-element array keeps later filters from repeating the parser: each text
    is read once, whatever is done with ``ts``.
    """
    return df.select("*", F.explode(F.array(normalize_timestamp(F.col("timestamp")))).alias("ts"))


def load_calls(df: DataFrame) -> DataFrame:
    """Numbers as plain digits and the time parsed, ready for lookups and filters."""
    return with_parsed_time(df).withColumns(
        {name: digits_only(F.col(name)) for name in ("caller_number", "called_number")}
    )


def parse_failures(df: DataFrame) -> DataFrame:
    """How many timestamps are present but unreadable."""
    lost = F.col("timestamp").isNotNull() & F.col("ts").isNull()
    return with_parsed_time(df).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("timestamp").alias("n_present"),
        F.count_if(lost).alias("parse_failures"),
    )
