"""Metrics of scored calls: counts, exact AUC, confusion, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.operators.ordered import running_totals


def _ratio(top: Column, bottom: Column) -> Column:
    """0/0 counts as 0."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def _cell(label: int, predicted: int) -> Column:
    return F.count_if((F.col("is_fraud") == label) & (F.col("prediction") == predicted))


def classification_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1 from ``is_fraud`` and ``prediction``."""
    cells = df.groupBy(*by).agg(
        _cell(1, 1).alias("tp"), _cell(0, 1).alias("fp"), _cell(1, 0).alias("fn"), _cell(0, 0).alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rates = cells.select(
        *by,
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
    )
    return rates.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def roc_auc(df: DataFrame, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve per group, ties counted half; null with one class only.

    Rows are combined per score before sorting. A group's pairs are won where a
    negative scores lower; the running number of negatives gives them in one pass.
    """
    by = list(by)
    fraud = F.col("is_fraud")
    cells = df.groupBy(*by, score).agg(
        F.sum(fraud).cast("bigint").alias("pos"), F.sum(1 - fraud).cast("bigint").alias("neg")
    )
    placed = running_totals(cells, [*by, score], ["neg"])
    # Running totals go on across groups; a group's own start is its smallest total.
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    wins = pos * (F.col("neg_before") + neg / 2)
    groups = placed.groupBy(*by).agg(
        F.sum(wins).alias("wins"),
        F.min("neg_before").cast("double").alias("start"),
        F.sum(pos).alias("p"),
        F.sum(neg).alias("n"),
    )
    area = F.try_divide(F.col("wins") - F.col("start") * F.col("p"), F.col("p") * F.col("n"))
    return groups.select(*by, area.alias("roc_auc"))


def confusion_matrix(df: DataFrame) -> DataFrame:
    """All four cells, also the empty ones."""
    wide = df.agg(*[_cell(y, p).alias(f"c{y}{p}") for y in (0, 1) for p in (0, 1)])
    return wide.select(
        F.expr("stack(4, 0, 0, c00, 0, 1, c01, 1, 0, c10, 1, 1, c11) as (is_fraud, prediction, n)")
    )


def class_report(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with plain and weighted means."""
    cells = df.agg(*[_cell(y, p).alias(f"c{y}{p}") for y in (0, 1) for p in (0, 1)])

    def one(name: str, hit: str, missed: str, wrong: str) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            _ratio(F.col(hit), F.col(hit) + F.col(wrong)).alias("precision"),
            _ratio(F.col(hit), F.col(hit) + F.col(missed)).alias("recall"),
            (F.col(hit) + F.col(missed)).alias("support"),
        )

    classes = cells.select(F.inline(F.array(one("0", "c00", "c01", "c10"), one("1", "c11", "c10", "c01"))))
    classes = classes.select(
        "class", "precision", "recall", _f1(F.col("precision"), F.col("recall")).alias("f1"), "support"
    )
    scores = ("precision", "recall", "f1")
    macro = classes.agg(*[F.avg(s).alias(s) for s in scores], F.sum("support").alias("support"))
    weighted = classes.agg(
        *[_ratio(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(s) for s in scores],
        F.sum("support").alias("support"),
    )
    return classes.unionByName(macro.withColumn("class", F.lit("macro avg"))).unionByName(
        weighted.withColumn("class", F.lit("weighted avg"))
    )


METRICS = ["accuracy", "roc_auc", "f1", "precision", "recall"]


def metric_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Long table of two one-row metric frames with their difference."""
    b = before.unpivot([], METRICS, "metric", "before")
    a = after.unpivot([], METRICS, "metric", "after")
    return b.join(a, "metric").withColumn("delta", F.col("after") - F.col("before"))
