"""Category spellings, the binary target and fixed projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.functions.texts import clean_channel, clean_label
from ringwatch.functions.risk import fraud_flag
from ringwatch.functions.times import normalize_timestamp
from ringwatch.schema import FRAUD_LABELS, LEGITIMATE_LABELS, PROJECTION_COLUMNS


def clean_categories(df: DataFrame) -> DataFrame:
    """Channel and label in their standard spelling."""
    return df.withColumns(
        {"channel": clean_channel(F.col("channel")), "label_5way": clean_label(F.col("label_5way"))}
    )


def build_targets(df: DataFrame) -> DataFrame:
    """Keep rows with a clear label and add ``is_fraud``; ambiguous labels are left out."""
    clear = F.col("label_5way").isin(FRAUD_LABELS + LEGITIMATE_LABELS)
    return df.filter(clear).withColumn("is_fraud", fraud_flag(F.col("label_5way")))


def target_summary(df: DataFrame) -> DataFrame:
    """Rows per target with its name and share, and how many of all rows were kept."""
    kept = F.col("label_5way").isin(FRAUD_LABELS + LEGITIMATE_LABELS)
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(kept).alias("rows_kept"),
        F.sum(fraud_flag(F.col("label_5way"))).alias("n_fraud"),
    )
    named = counts.select(
        "rows_before",
        "rows_kept",
        (F.col("rows_before") - F.col("rows_kept")).alias("rows_dropped"),
        F.expr(
            "stack(2, 0, 'Not fraud', rows_kept - n_fraud, 1, 'Fraud', n_fraud) as (is_fraud, label, n)"
        ),
    )
    return named.filter(F.col("n") > 0).withColumn("share", F.try_divide(F.col("n"), F.col("rows_kept")))


def call_projection(df: DataFrame) -> DataFrame:
    """The fixed set of columns that views work on, with the time parsed."""
    return df.withColumn("timestamp", normalize_timestamp(F.col("timestamp"))).select(*PROJECTION_COLUMNS)


def align_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``columns`` in this order; a missing one is 0."""
    present = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in present else F.lit(0).alias(c) for c in columns])


def first_present(df: DataFrame, names: Sequence[str]) -> str | None:
    """The first of ``names`` that is a column of ``df``."""
    return next((name for name in names if name in df.columns), None)
