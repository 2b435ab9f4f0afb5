"""Quality checks of a call table: hard checks in one pass, null profile, gate."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ringwatch.functions.risk import fraud_flag
from ringwatch.functions.texts import canonical_label
from ringwatch.schema import CALL_COLUMNS, CANONICAL_FRAUD_LABELS, CANONICAL_LABELS

# --- Fixed values: the published bands of the checks. ---
ROW_BAND = (4500, 5500)
FRAUD_BAND = (0.10, 0.20)
DURATION_BAND = (0, 3600)
CONFIDENCE_BAND = (0, 1)
# --- End of fixed values. ---


def unknown_labels(df: DataFrame, allowed: Sequence[str] = CANONICAL_LABELS) -> DataFrame:
    """Labels that are not allowed even in canonical spelling."""
    label = canonical_label(F.col("label_5way"))
    return df.filter(~label.isin(list(allowed))).select(label.alias("label")).distinct()


def _measures(df: DataFrame) -> list[Column]:
    """The aggregates that all checks need; those of columns that the table lacks are left out."""
    measures = [F.count(F.lit(1)).alias("n")]
    if "label_5way" in df.columns:
        label = canonical_label(F.col("label_5way"))
        odd = label.isNotNull() & ~label.isin(CANONICAL_LABELS)
        measures += [
            F.avg(fraud_flag(label, CANONICAL_FRAUD_LABELS)).alias("rate"),
            F.count_if(odd).alias("odd"),
            F.collect_set(F.when(odd, label)).alias("odd_labels"),
        ]
    for column in ("duration_sec", "confidence_score"):
        if column in df.columns:
            measures += [F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}")]
    return measures


def quality_checks(
    df: DataFrame,
    row_band: tuple[float, float] = ROW_BAND,
    fraud_band: tuple[float, float] = FRAUD_BAND,
    required: Sequence[str] = CALL_COLUMNS,
) -> DataFrame:
    """``check_name, passed, message`` per hard check, from one aggregation of the table.

    A missing column fails ``required_columns``; the checks of its values are then left out.
    """
    missing = [c for c in required if c not in df.columns]
    return _checks(df.agg(*_measures(df)), missing, row_band, fraud_band)


def _checks(
    facts: DataFrame, missing: Sequence[str], row_band: tuple[float, float], fraud_band: tuple[float, float]
) -> DataFrame:
    """The checks of one row of measures."""
    has_label = "odd" in facts.columns
    has_duration, has_confidence = (f"min_{c}" in facts.columns for c in ("duration_sec", "confidence_score"))

    def within(column: str, low: float, high: float):
        value_ok = (F.col(f"min_{column}") >= low) & (F.col(f"max_{column}") <= high)
        return F.coalesce(value_ok, F.lit(True))  # no value at all breaks no bound

    def span(column: str):
        return F.format_string("min=%s, max=%s", F.col(f"min_{column}").cast("string"), F.col(f"max_{column}").cast("string"))

    checks = [
        ("required_columns", F.lit(not missing), F.lit(f"missing: {missing}" if missing else "ok")),
        ("row_count", F.col("n").between(*row_band), F.format_string("actual: %d", F.col("n"))),
    ]
    if has_label:
        rate = F.round("rate", 3).cast("decimal(10,3)").cast("string")
        named = F.array_join(F.array_sort("odd_labels"), ", ")
        checks += [
            (
                "fraud_rate",
                F.coalesce(F.col("rate").between(*fraud_band), F.lit(False)),
                F.concat(F.lit("actual: "), F.coalesce(rate, F.lit("none"))),
            ),
            (
                "known_labels",
                F.col("odd") == 0,
                F.when(F.col("odd") == 0, "ok").otherwise(F.format_string("rows: %d, labels: %s", F.col("odd"), named)),
            ),
        ]
    if has_duration:
        checks.append(("duration_range", within("duration_sec", *DURATION_BAND), span("duration_sec")))
    if has_confidence:
        checks.append(("confidence_range", within("confidence_score", *CONFIDENCE_BAND), span("confidence_score")))
    rows = [
        F.struct(F.lit(name).alias("check_name"), passed.alias("passed"), message.alias("message"))
        for name, passed, message in checks
    ]
    return facts.select(F.inline(F.array(*rows)))


class QualityError(ValueError):
    """At least one hard check failed."""


def quality_gate(checks: DataFrame) -> None:
    """Raise if any check failed; the checks are a handful of rows."""
    failed = [f"{r['check_name']} ({r['message']})" for r in checks.filter(~F.col("passed")).collect()]
    if failed:
        raise QualityError("; ".join(failed))


def write_checked(
    df: DataFrame,
    path: str,
    row_band: tuple[float, float] = ROW_BAND,
    fraud_band: tuple[float, float] = FRAUD_BAND,
    required: Sequence[str] = CALL_COLUMNS,
) -> None:
    """Write ``df`` as Parquet to the new folder ``path``, but only if it passes all hard checks.

    The measures are taken while the rows are written, to a folder beside ``path``. That is then
    renamed; a table that fails leaves nothing and raises :class:`QualityError`.
    """
    spark = df.sparkSession
    missing = [c for c in required if c not in df.columns]
    measures = _measures(df)
    seen = Observation()
    waiting = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    files = spark._jvm.org.apache.hadoop.fs
    source, target = files.Path(waiting), files.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(target):
        raise FileExistsError(path)
    try:
        df.observe(seen, *measures).write.parquet(waiting)
        schema = df.agg(*measures).schema
        facts = spark.createDataFrame([tuple(seen.get[name] for name in schema.names)], schema)
        quality_gate(_checks(facts, missing, row_band, fraud_band))
        if not system.rename(source, target):
            raise OSError(f"could not move {waiting} to {path}")
    finally:
        system.delete(source, True)


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column that has any, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "nulls").filter(F.col("nulls") > 0)


def table_facts(df: DataFrame) -> DataFrame:
    """Rows, columns and null cells in all."""
    cells = [F.col(c).isNull().cast("int") for c in df.columns]
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.sum(sum(cells[1:], cells[0])).alias("null_cells"),
    )
