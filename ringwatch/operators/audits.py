"""Leak audits: shuffled labels, single features, permuted features."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.operators import swapped
from ringwatch.operators.evaluate import roc_auc
from ringwatch.operators.models import SEED, Fitted, FixedScore, filled_columns
from ringwatch.operators.ordered import mid_ranks, random_choices, random_key, row_numbers
from ringwatch.session import store


def _in_random_order(df: DataFrame, repeats: int, seed: int) -> DataFrame:
    """``df`` once per repeat with ``place`` 0..n-1 in a random order of its own.

    The order is a hash of call, repeat and seed, so it is the same whenever and
    wherever a task runs. All repeats are numbered in one distributed sort.
    """
    repeated = df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    shuffled = repeated.withColumn("__order", random_key("call_id", seed))
    numbered = row_numbers(shuffled, ["repeat", "__order", "call_id"])
    # Every repeat has all rows, so the place within it is the remainder.
    n = df.agg(F.count(F.lit(1))).scalar()
    return numbered.withColumn("place", (F.col("row_no") - 1) % n).drop("row_no", "__order")


def label_permutation(scored: DataFrame, score: str, repeats: int = 20, seed: int = SEED) -> DataFrame:
    """AUC with true labels, and mean and deviation of the AUC with shuffled labels.

    Calls are scored and ranked once. Shuffling labels means that a random choice of as
    many calls as there are frauds becomes the positive class, whose ranks give the area.
    """
    ranked = mid_ranks(scored.select("call_id", "is_fraud", F.col(score).alias("score")), "score", ["call_id"])
    slim = store(ranked.select("call_id", "is_fraud", "mid_rank"), "ranked-calls")
    rows, frauds = slim.agg(F.count(F.lit(1)), F.coalesce(F.sum("is_fraud"), F.lit(0))).first()

    def area(ranks):
        # The ranks of the positive class, less those it has among itself.
        won = ranks - frauds * (frauds + 1) / 2
        return F.try_divide(won, F.lit(float(frauds * (rows - frauds))))

    chosen = random_choices(slim.select("call_id", "mid_rank"), "call_id", frauds, repeats, seed)
    areas = chosen.groupBy("repeat").agg(area(F.sum("mid_rank")).alias("roc_auc"))
    base = slim.agg(area(F.sum(F.when(F.col("is_fraud") == 1, F.col("mid_rank"))))).scalar()
    return areas.agg(
        F.avg("roc_auc").alias("shuffled_mean_auc"), F.stddev_pop("roc_auc").alias("shuffled_std_auc")
    ).select(base.alias("base_auc"), "*")


def single_feature_auc(train: DataFrame, test: DataFrame, features: Sequence[str]) -> DataFrame:
    """Test AUC that each feature reaches alone, null as 0.

    A logistic score of one feature rises or falls with it, as its covariance with
    the label in training says. So its AUC is that of the feature itself with this
    sign, and all features are ranked in one pass without fitting anything.
    """

    def value(c: str):
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0))

    signs = train.agg(*[F.signum(F.covar_pop(value(c), F.col("is_fraud"))).alias(c) for c in features]).first()
    long = test.select("is_fraud", *[(value(c) * F.lit(signs[c] or 0.0)).alias(c) for c in features]).unpivot(
        ["is_fraud"], list(features), "feature", "score"
    )
    return roc_auc(long, "score", ["feature"]).orderBy(F.desc("roc_auc"), "feature")


#: Pairs of a call and a donor that one task scores.
PAIRS_PER_TASK = 50_000


def _paired(rows: DataFrame, donated, repeats: int, seed: int) -> DataFrame:
    """Each row once per ``repeat``, with what the next call in a random ring gives as ``donor``."""
    n = rows.agg(F.count(F.lit(1))).scalar()
    places = store(_in_random_order(rows.select("call_id"), repeats, seed), "places")
    placed = places.join(rows, "call_id")
    donors = placed.select("repeat", F.pmod(F.col("place") - 1, n).alias("place"), donated.alias("donor"))
    return placed.join(donors, ["repeat", "place"])


def _forest_areas(valid_rows: DataFrame, fitted: Fitted, repeats: int, seed: int) -> DataFrame:
    """``feature, repeat, roc_auc, base``, all features and repeats of a call going down the trees together."""
    trees, thresholds = swapped.trees_of(valid_rows, fitted.estimator)
    filled = PipelineModel(fitted.pipeline.stages[:1]).transform(valid_rows)
    codes = swapped.coded(filled, filled_columns(fitted), thresholds, ["call_id", "is_fraud"])
    rows = store(codes, "validation-codes")
    n = rows.count()
    pairs = _paired(rows, F.col("codes"), repeats, seed)
    # The repeats of a call lie together, so that its paths are found once.
    together = pairs.repartition(max(1, math.ceil(n * repeats / PAIRS_PER_TASK)), "call_id").sortWithinPartitions("call_id")
    areas = store(swapped.areas(rows, together, trees, len(fitted.features), n), "permuted-areas")
    base = areas.filter(F.col("feature") == swapped.BASE).select("roc_auc").scalar()
    name = F.element_at(F.lit(fitted.features), F.col("feature") + 1)
    return areas.filter("feature >= 0").select(name.alias("feature"), "repeat", "roc_auc", base.alias("base"))


def _scored_areas(valid_rows: DataFrame, fitted: Fitted | FixedScore, repeats: int, seed: int) -> DataFrame:
    """``feature, repeat, roc_auc, base`` of any model: only calls that get another value are scored again."""
    features, score = fitted.features, f"{fitted.name}_p"
    base_rows = store(fitted.score(valid_rows).select(*valid_rows.columns, F.col(score).alias("__p")), "validation-scores")
    base = roc_auc(base_rows, "__p").scalar()
    pairs = store(_paired(base_rows, F.struct(*features), repeats, seed).drop("call_id", "place"), "pairs")
    swaps = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"donor.{c}").eqNullSafe(F.col(c)).alias("__same"),
                *[(F.col(f"donor.{x}") if x == c else F.col(x)).alias(x) for x in features],
            )
            for c in features
        ]
    )
    swaps_made = pairs.select("is_fraud", "repeat", "__p", F.inline(swaps))
    kept = swaps_made.filter("__same").select("is_fraud", "repeat", "feature", F.col("__p").alias(score))
    changed = fitted.score(swaps_made.filter("not __same").drop("__same", "__p"))
    areas = roc_auc(changed.select(*kept.columns).unionByName(kept), score, ["feature", "repeat"])
    return areas.withColumn("base", base)


def permutation_importance(
    valid: DataFrame, fitted: Fitted | FixedScore, repeats: int = 10, seed: int = SEED
) -> DataFrame:
    """Mean and population deviation of the AUC lost when a feature is shuffled.

    In each repeat a call takes the feature value of the next call in a random
    ring. All repeats are paired by one join, then every feature is swapped; the
    areas are computed per (feature, repeat) together. Forests have a way of their own
    to score swapped calls, see :mod:`~ringwatch.operators.swapped`.
    """
    valid_rows = store(valid.select("call_id", "is_fraud", *fitted.features), "validation")
    forest = isinstance(fitted, Fitted) and isinstance(fitted.estimator, RandomForestClassificationModel)
    areas = (_forest_areas if forest else _scored_areas)(valid_rows, fitted, repeats, seed)
    lost = areas.withColumn("lost", F.col("base") - F.col("roc_auc"))
    return (
        lost.groupBy("feature")
        .agg(F.avg("lost").alias("importance"), F.stddev_pop("lost").alias("std"))
        .orderBy(F.desc("importance"), "feature")
    )
