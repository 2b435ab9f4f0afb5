"""Classifiers on the feature matrix, built from ``pyspark.ml``.

Filling and scaling are fitted once and stored in the pipeline as SQL stages,
so a saved model carries them along and scores batch and stream alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.functions.risk import probability_band
from ringwatch.operators import boosting_grid, forest
from ringwatch.operators.evaluate import METRICS, classification_metrics, roc_auc
from ringwatch.operators.features import class_weights, fit_scaling
from ringwatch.operators.ordered import median_values, row_numbers
from ringwatch.schema import BASE_FEATURES, SCALED_FEATURES
from ringwatch.session import checkpoint_root, store

SEED = 42
#: The deepest trees that Spark grows; the published forest has no limit.
MAX_DEPTH = 30
#: Least share of all rows in a leaf of the forest. Trees come to the driver: this bounds their leaves
#: whatever the number of rows, and says nothing at the published size.
LEAST_SHARE = 1e-6


@dataclass
class Fitted:
    """A named model with its prepared input, one set of output columns per name."""

    name: str
    pipeline: PipelineModel
    features: list[str]

    @property
    def estimator(self):
        return self.pipeline.stages[-1]

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``<name>_p``, the fraud probability, and ``<name>_prediction``."""
        scored = self.pipeline.transform(df)
        raw = [f"{self.name}_features", f"{self.name}_raw", f"{self.name}_probability"]
        filled = [_filled(self.name, c) for c in self.features]
        return (
            scored.withColumn(f"{self.name}_p", vector_to_array(f"{self.name}_probability")[1])
            .withColumn(f"{self.name}_prediction", F.col(f"{self.name}_prediction").cast("int"))
            .drop(*raw, *filled)
        )


@dataclass
class FixedScore:
    """A score by formula in the place of a fitted model: ``probability`` is SQL over ``features``."""

    name: str
    features: list[str]
    probability: str

    def score(self, df: DataFrame) -> DataFrame:
        scored = df.withColumn(f"{self.name}_p", F.expr(self.probability))
        return scored.withColumn(f"{self.name}_prediction", (F.col(f"{self.name}_p") > 0.5).cast("int"))


def _filled(name: str, column: str) -> str:
    return f"__{name}_{column}"


def filled_columns(fitted: Fitted) -> list[str]:
    """The columns of a model's inputs after the first stage of its pipeline: numbers without nulls."""
    return [_filled(fitted.name, c) for c in fitted.features]


@dataclass
class Facts:
    """What models need to know of a training part: a few numbers per column and class."""

    medians: dict[str, float]
    scaling: dict[str, tuple[float, float]]
    weights: dict[int, float]
    n: int


def facts_of(
    train: DataFrame, features: Sequence[str], scaled: bool = True, fill: str = "median", balanced: bool = True
) -> Facts:
    """Measure a training part once; several models can then be fitted from it."""
    flags = {f.name for f in train.schema.fields if f.dataType.typeName() == "boolean"}
    numeric = [c for c in features if c not in flags and not c.startswith("channel_")]
    classes = class_weights(train).collect() if balanced else []
    return Facts(
        median_values(train, numeric) if fill == "median" else {},
        fit_scaling(train, [c for c in SCALED_FEATURES if c in features]) if scaled else {},
        {row["is_fraud"]: row["weight"] for row in classes},
        sum(row["n"] for row in classes),
    )


def fit_preparation(
    train: DataFrame,
    name: str,
    features: Sequence[str],
    scaled: bool,
    fill: str = "median",
    facts: Facts | None = None,
) -> list:
    """Stages that scale, fill and assemble ``features``, fitted on ``train`` or taken from its ``facts``.

    Scaling comes first and nulls pass through it; filling by the median commutes
    with it, filling by zero means the mean of a scaled column.
    """
    facts = facts or facts_of(train, features, scaled, fill, balanced=False)
    scaling = facts.scaling if scaled else {}
    medians = facts.medians if fill == "median" else {}

    def expression(column: str) -> str:
        value = f"cast(`{column}` as double)"
        default = medians.get(column) or 0.0
        if column in scaling:
            mean, deviation = scaling[column]
            value = f"(({value} - {mean!r}D) / {deviation!r}D)"
            if fill == "median":
                default = (default - mean) / deviation
        return f"coalesce({value}, {float(default)!r}D) AS `{_filled(name, column)}`"

    columns = ", ".join(expression(c) for c in features)
    return [
        SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__"),
        VectorAssembler(inputCols=[_filled(name, c) for c in features], outputCol=f"{name}_features"),
    ]


def _outputs(name: str) -> dict[str, str]:
    return {
        "featuresCol": f"{name}_features",
        "labelCol": "is_fraud",
        "predictionCol": f"{name}_prediction",
        "probabilityCol": f"{name}_probability",
        "rawPredictionCol": f"{name}_raw",
    }


def with_balanced_weights(train: DataFrame, facts: Facts) -> DataFrame:
    """Add ``weight``; the two classes put two numbers into the plan."""
    weight = F.lit(1.0)
    for label, value in facts.weights.items():
        weight = F.when(F.col("is_fraud") == label, F.lit(value)).otherwise(weight)
    return train.withColumn("weight", weight)


def without_summary(df: DataFrame, model):
    """``model`` as it is after saving and loading; ``df`` lends its session.

    A fitted model keeps a summary of its training, which goes into every task that scores and drags
    the session along. A session in which something was observed cannot be sent, so nothing could be scored.
    """
    if not getattr(model, "hasSummary", False):
        return model
    path = f"{checkpoint_root(df.sparkSession)}/fitted-{uuid.uuid4().hex}"
    model.write().save(path)
    return type(model).load(path)


def _fit(
    train: DataFrame, name: str, features: Sequence[str], scaled: bool, fill: str, estimator, facts: Facts | None = None
) -> Fitted:
    stages = fit_preparation(train, name, features, scaled, fill, facts)
    prepared = PipelineModel(stages).transform(train)
    model = without_summary(train, estimator.fit(prepared))
    return Fitted(name, PipelineModel([*stages, model]), list(features))


def fit_logistic(
    train: DataFrame,
    features: Sequence[str] = BASE_FEATURES,
    fill: str = "median",
    scaled: bool = True,
    max_iter: int = 1000,
    name: str = "logistic",
    facts: Facts | None = None,
) -> Fitted:
    """Logistic regression with balanced weights and an L2 penalty of strength 1.

    Spark averages the loss, so a penalty of 1 on the sum is 1/n here; balanced
    weights sum to n.
    """
    facts = facts or facts_of(train, features, scaled, fill)
    estimator = LogisticRegression(
        **_outputs(name),
        weightCol="weight",
        maxIter=max_iter,
        elasticNetParam=0.0,
        regParam=1.0 / facts.n,
        standardization=False,
    )
    return _fit(with_balanced_weights(train, facts), name, features, scaled, fill, estimator, facts)


def fit_forest(
    train: DataFrame,
    features: Sequence[str] = BASE_FEATURES,
    trees: int = 200,
    depth: int = MAX_DEPTH,
    fill: str = "median",
    name: str = "forest",
    facts: Facts | None = None,
) -> Fitted:
    """A forest with balanced weights; :mod:`~ringwatch.operators.forest` grows the trees of Spark's model."""
    facts = facts or facts_of(train, features, False, fill)
    estimator = RandomForestClassifier(
        **_outputs(name),
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        featureSubsetStrategy="sqrt",
        minWeightFractionPerNode=LEAST_SHARE,
        seed=SEED,
    )
    stages = fit_preparation(train, name, features, False, fill, facts)
    prepared = PipelineModel(stages[:1]).transform(train)
    model = forest.fit(prepared, [_filled(name, c) for c in features], estimator, facts.weights)
    return Fitted(name, PipelineModel([*stages, model]), list(features))


def boosting(name: str, iterations: int = 100, step: float = 0.1, depth: int = 3) -> GBTClassifier:
    columns = _outputs(name)
    estimator = GBTClassifier(
        featuresCol=columns["featuresCol"],
        labelCol=columns["labelCol"],
        predictionCol=columns["predictionCol"],
        maxIter=iterations,
        stepSize=step,
        maxDepth=depth,
        seed=SEED,
        cacheNodeIds=True,
        checkpointInterval=10,
    )
    return estimator.setProbabilityCol(columns["probabilityCol"]).setRawPredictionCol(columns["rawPredictionCol"])


def fit_boosting(
    train: DataFrame,
    features: Sequence[str] = BASE_FEATURES,
    iterations: int = 100,
    step: float = 0.1,
    depth: int = 3,
    fill: str = "median",
    name: str = "boosting",
    facts: Facts | None = None,
) -> Fitted:
    """Gradient boosting; :mod:`~ringwatch.operators.boosting_grid` grows the trees of Spark's model."""
    stages = fit_preparation(train, name, features, False, fill, facts)
    prepared = PipelineModel(stages[:1]).transform(train)
    columns = [_filled(name, c) for c in features]
    model = boosting_grid.fit(prepared, columns, boosting(name, iterations, step, depth))
    return Fitted(name, PipelineModel([*stages, model]), list(features))


def stratified_folds(train: DataFrame, folds: int) -> DataFrame:
    """``train`` with ``fold``, 0 to ``folds`` - 1: the calls of each class in a random order, dealt out one by one.

    So folds differ by one call of a class at most. The order is a hash of the call's id; calls of one id
    are told apart by all their columns.
    """
    order = [F.col("is_fraud"), F.xxhash64("call_id"), F.col("call_id"), F.xxhash64(*train.columns)]
    numbered = row_numbers(train, order, "__place")
    # A class follows the other, so that the calls of each have places one after the other.
    return numbered.withColumn("fold", F.pmod("__place", F.lit(folds)).cast("int")).drop("__place")


def cross_validate(
    train: DataFrame,
    features: Sequence[str] = BASE_FEATURES,
    iterations: Sequence[int] = (100, 150, 200),
    steps: Sequence[float] = (0.03, 0.05, 0.1),
    depths: Sequence[int] = (2, 3, 4),
    folds: int = 3,
    name: str = "boosting",
) -> DataFrame:
    """Cross-validated ROC-AUC of every parameter point, best first.

    Folds are stratified. All points and folds are boosted together, see
    :mod:`~ringwatch.operators.boosting_grid`.
    """
    stages = fit_preparation(train, name, features, scaled=False)
    columns = [_filled(name, c) for c in features]
    prepared = PipelineModel(stages[:1]).transform(train).select("call_id", "is_fraud", *columns)
    folded = stratified_folds(prepared, folds).select("fold", "is_fraud", *columns)
    table = boosting_grid.cross_validated_areas(store(folded, "grid-calls"), columns, iterations, steps, depths, folds)
    return store(table, "grid-areas").orderBy(F.desc("mean_roc_auc"), "iterations", "step", "depth")


def grid_search(
    train: DataFrame, features: Sequence[str] = BASE_FEATURES, name: str = "boosting", **grid
) -> tuple[DataFrame, Fitted]:
    """The table of :func:`cross_validate` and its best point, refitted on all rows."""
    ranked = cross_validate(train, features, name=name, **grid)
    top = ranked.first()
    return ranked, fit_boosting(train, features, top["iterations"], top["step"], top["depth"], name=name)


def refit_report(ranked: DataFrame, metrics: DataFrame) -> DataFrame:
    """The points of :func:`grid_search` with a ``best`` mark, and at the best one ``test_...``: ``metrics`` of its refit."""
    top = ranked.first()
    best = (F.col("iterations") == top["iterations"]) & (F.col("step") == top["step"]) & (F.col("depth") == top["depth"])
    one = F.broadcast(metrics.select(*[F.col(m).alias(f"test_{m}") for m in METRICS]))
    marked = ranked.withColumn("best", best).crossJoin(one)
    measured = marked.withColumns({f"test_{m}": F.when(F.col("best"), F.col(f"test_{m}")) for m in METRICS})
    return measured.orderBy(F.desc("mean_roc_auc"), "iterations", "step", "depth")


def vote(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean of the probabilities ``<name>_p``, as the columns of a model called ``vote``."""
    total = sum((F.col(f"{n}_p") for n in names[1:]), F.col(f"{names[0]}_p"))
    return df.withColumn("vote_p", total / len(names)).withColumn("vote_prediction", (F.col("vote_p") > 0.5).cast("int"))


def soft_vote(df: DataFrame, members: Sequence[Fitted]) -> DataFrame:
    """Mean of the members' probabilities; each member only adds columns, so nothing is joined."""
    for member in members:
        df = member.score(df)
    return vote(df, [m.name for m in members])


def compare_models(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One metric row per model that has scored ``df``, all from one pass over it."""
    stacked = F.inline(
        F.array(
            *[
                F.struct(F.lit(n).alias("model"), F.col(f"{n}_prediction").alias("prediction"), F.col(f"{n}_p").alias("p"))
                for n in names
            ]
        )
    )
    # Scoring is the costly part: both measures read what is stored.
    long = store(df.select("is_fraud", stacked), "scored-models")
    areas = roc_auc(long, "p", ["model"])
    # One row per model on either side.
    return classification_metrics(long, ["model"]).join(areas, "model").select("model", *METRICS)


def scored_metrics(df: DataFrame, name: str) -> DataFrame:
    """Metrics of the columns that the model ``name`` added."""
    return compare_models(df, [name])


def best_model(metrics: DataFrame, order: Sequence[str]) -> str:
    """The name with the highest ROC-AUC; on a tie the earlier one in ``order``."""
    area = {r["model"]: r["roc_auc"] for r in metrics.select("model", "roc_auc").collect()}
    return max(order, key=lambda name: area[name])


def mark_best(metrics: DataFrame, order: Sequence[str]) -> DataFrame:
    """``metrics`` with a ``best`` mark on the model that :func:`best_model` picks."""
    return metrics.withColumn("best", F.col("model") == best_model(metrics, order))


def score_calls(df: DataFrame, fitted: Fitted, keep: Sequence[str] = ("call_id",)) -> DataFrame:
    """Class, fraud probability, confidence in the class, and risk band for each call."""
    return call_scores(fitted.score(df), fitted.name, keep)


def call_scores(scored: DataFrame, name: str, keep: Sequence[str] = ("call_id",)) -> DataFrame:
    """The same from the columns that the model ``name`` has added."""
    p = F.col(f"{name}_p")
    return scored.select(
        *keep,
        F.col(f"{name}_prediction").alias("prediction"),
        p.alias("fraud_probability"),
        F.greatest(p, 1 - p).alias("confidence"),
        probability_band(p).alias("risk_band"),
    )


def save_model(fitted: Fitted, path: str) -> None:
    """Write the whole pipeline; its stages hold feature names, medians and scaling."""
    fitted.pipeline.write().overwrite().save(path)


def load_model(path: str) -> Fitted:
    pipeline = PipelineModel.load(path)
    assembler = next(s for s in pipeline.stages if isinstance(s, VectorAssembler))
    name = assembler.getOutputCol().removesuffix("_features")
    lead = _filled(name, "")
    return Fitted(name, pipeline, [c.removeprefix(lead) for c in assembler.getInputCols()])


# --- What a model relies on -------------------------------------------------


def _table(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


def impurity_importance(df: DataFrame, fitted: Fitted) -> DataFrame:
    """Importance of each feature of a tree model, largest first; ``df`` lends its session."""
    values = fitted.estimator.featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(fitted.features, values)]
    return _table(df, rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def coefficient_report(df: DataFrame, fitted: Fitted) -> DataFrame:
    """Coefficients of a linear model ranked by absolute value."""
    rows = sorted(zip(fitted.features, map(float, fitted.estimator.coefficients)), key=lambda r: (-abs(r[1]), r[0]))
    ranked: list[tuple] = [(f, c, abs(c), i + 1) for i, (f, c) in enumerate(rows)]
    return _table(df, ranked, "feature string, coef double, abs_coef double, rank int")


def coefficient_scores(df: DataFrame, fitted: Fitted) -> DataFrame:
    """``df`` with ``coefficient_p``: the probability that the rows of :func:`coefficient_report` and the intercept give."""
    report = {r["feature"]: r["coef"] for r in coefficient_report(df, fitted).collect()}
    prepared = PipelineModel(fitted.pipeline.stages[:-1]).transform(df)
    terms = [F.lit(report[c]) * F.col(_filled(fitted.name, c)) for c in fitted.features]
    line = sum(terms, F.lit(float(fitted.estimator.intercept)))
    return prepared.select(*df.columns, (1 / (1 + F.exp(-line))).alias("coefficient_p"))


def logistic_gradient(train: DataFrame, fitted: Fitted) -> DataFrame:
    """Per feature, the gradient of the penalised objective at the fitted coefficients, per row: 0 at the optimum."""
    facts = facts_of(train, fitted.features, scaled=False, fill="none")
    scored = fitted.pipeline.transform(with_balanced_weights(train, facts))
    error = F.col("weight") * (vector_to_array(f"{fitted.name}_probability")[1] - F.col("is_fraud"))
    inputs = vector_to_array(f"{fitted.name}_features")
    coefficients = list(map(float, fitted.estimator.coefficients))
    sums = scored.agg(
        *[(F.sum(error * inputs[k]) + F.lit(c)).alias(f) for k, (f, c) in enumerate(zip(fitted.features, coefficients))]
    )
    long = sums.unpivot([], fitted.features, "feature", "gradient")
    return long.withColumn("gradient", F.abs(F.col("gradient")) / facts.n)


def compare_importances(permutation: DataFrame, impurity: DataFrame) -> DataFrame:
    """Both importances per feature, by the permutation one; one row per feature on each side."""
    return (
        permutation.withColumnRenamed("importance", "importance_perm")
        .join(F.broadcast(impurity.withColumnRenamed("importance", "importance_rf")), "feature")
        .orderBy(F.desc("importance_perm"), "feature")
    )
