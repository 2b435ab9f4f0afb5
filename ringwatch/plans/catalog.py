"""The registered queries: every operator over the whole call table of a data folder."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ringwatch.functions import risk, texts, times
from ringwatch.operators import audits, cleaning, dedup, evaluate, explore, lookup, models, ordered, quality, trailing
from ringwatch.operators import features as feat
from ringwatch.plans import prepare, train
from ringwatch.schema import (
    ACTION_FLAGS,
    BASE_FEATURES,
    CALL_COLUMNS,
    KEYWORD_PATTERNS,
    SCALED_FEATURES,
    TRAILING_FEATURES,
)
from ringwatch.session import checkpoint_root, store
from ringwatch.sources import number_layout
from ringwatch.sources.calls import load_calls, parse_failures, read_calls, replace_days, with_parsed_time, write_calls
from ringwatch.sources.event_calls import read_event_calls
from ringwatch.streaming import carried, scoring

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# Parameters of the queries that take some; the SQL checks use the same.
LOOKUP_NUMBER = "+372 6000 003"
LOOKUP_PREFIX = "+372 50000 01"
FILTER = {
    "start": dt.date(2024, 1, 5),
    "end": dt.date(2024, 1, 20),
    "labels": ["Confirmed_Fraud", "Unknown"],
    "prefix": "+37250",
    "channels": ["Mobile", "VoIP"],
}
BUSY_CALLS = 70
CORRECTED_DAY = dt.date(2024, 1, 10)
SKETCH_RANK_ERROR = 0.01


def _query(name: str):
    def register(function: Query) -> Query:
        _QUERIES[name] = function
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- Frames ----------------------------------------------------------------


def raw_calls(spark: SparkSession, folder: str) -> DataFrame:
    return read_event_calls(spark, folder)


def timed_calls(spark: SparkSession, folder: str) -> DataFrame:
    return with_parsed_time(raw_calls(spark, folder))


def clean_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Every call in standard spelling; each query reads only what it needs of it."""
    return cleaning.clean_categories(raw_calls(spark, folder))


def clean_timed_calls(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_categories(timed_calls(spark, folder))


def labelled_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled calls without duplicates, as models use them."""
    return cleaning.build_targets(prepare.clean_table(raw_calls(spark, folder)))


def _rounded(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    """Sums of doubles depend on their order in the last digits, so checks see fewer."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def _short(name: str) -> str:
    """A keyword's name as a plain column name."""
    return "kw_" + "".join(ch if ch.isalnum() else "_" for ch in name.lower()).strip("_")


KEYWORD_COLUMNS = {name: _short(name) for name in KEYWORD_PATTERNS}


# --- Sources, projections, scalar functions --------------------------------


@_query("load_calls")
def _(spark, folder):
    return load_calls(raw_calls(spark, folder))


@_query("ts_normalize")
def _(spark, folder):
    return timed_calls(spark, folder).select("call_id", "timestamp", "ts", times.floor_minute(F.col("ts")).alias("minute"))


@_query("ts_parse_failures")
def _(spark, folder):
    return parse_failures(raw_calls(spark, folder))


@_query("clean_channel")
def _(spark, folder):
    return raw_calls(spark, folder).select("call_id", "channel", texts.clean_channel(F.col("channel")).alias("clean"))


@_query("clean_label")
def _(spark, folder):
    return raw_calls(spark, folder).select("call_id", "label_5way", texts.clean_label(F.col("label_5way")).alias("clean"))


@_query("clean_calls")
def _(spark, folder):
    return cleaning.clean_categories(raw_calls(spark, folder))


@_query("canon_label")
def _(spark, folder):
    return raw_calls(spark, folder).select("call_id", texts.canonical_label(F.col("label_5way")).alias("label"))


@_query("temporal_features")
def _(spark, folder):
    return feat.add_temporal_features(timed_calls(spark, folder)).select(
        "call_id", "hour", "weekday", times.weekday_name(F.col("ts")).alias("day_name"), "is_weekend", "is_business_hours"
    )


@_query("temporal_float")
def _(spark, folder):
    return feat.add_temporal_floats(timed_calls(spark, folder)).select(
        "call_id", "hour", "weekday", "is_weekend", "is_business_hours", "time_to_next_action_sec"
    )


@_query("caller_prefix")
def _(spark, folder):
    number = F.col("caller_number")
    return raw_calls(spark, folder).select(
        "call_id", texts.digits_only(number).alias("digits"), texts.number_prefix(number).alias("prefix")
    )


@_query("keyword_flags")
def _(spark, folder):
    flagged = explore.with_keyword_flags(raw_calls(spark, folder))
    return flagged.select("call_id", *[F.col(f"`{name}`").alias(short) for name, short in KEYWORD_COLUMNS.items()])


@_query("keyword_score")
def _(spark, folder):
    return explore.with_keyword_score(raw_calls(spark, folder)).select("call_id", "complaint_keyword_score")


@_query("call_projection")
def _(spark, folder):
    return cleaning.call_projection(raw_calls(spark, folder))


@_query("align_columns")
def _(spark, folder):
    temporal = feat.add_temporal_features(timed_calls(spark, folder)).drop("channel")
    return cleaning.align_columns(temporal, BASE_FEATURES, keep=["call_id"])


@_query("filter_calls")
def _(spark, folder):
    calls = cleaning.clean_categories(load_calls(raw_calls(spark, folder)))
    return lookup.filter_calls(calls, **FILTER).select("call_id", "caller_number", "ts", "label_5way", "channel")


@_query("lookup_history")
def _(spark, folder):
    return lookup.lookup_history(load_calls(raw_calls(spark, folder)), LOOKUP_NUMBER).select(
        "call_id", "caller_number", "called_number", "ts", "channel", "label_5way", "confidence_score"
    )


@_query("lookup_history_prefix")
def _(spark, folder):
    return lookup.lookup_history(load_calls(raw_calls(spark, folder)), LOOKUP_PREFIX).select(
        "call_id", "caller_number", "called_number", "ts", "channel", "label_5way", "confidence_score"
    )


@_query("lookup_stored")
def _(spark, folder):
    """The history of a number from calls laid out by number."""
    path = f"{checkpoint_root(spark)}/by-number-{uuid.uuid4().hex}"
    number_layout.write_by_number(load_calls(raw_calls(spark, folder)), path)
    return number_layout.stored_matches(spark, path, LOOKUP_PREFIX).select(
        "call_id", "caller_number", "ts", "label_5way", "confidence_score"
    )


@_query("lookup_risk")
def _(spark, folder):
    history = lookup.matching_calls(load_calls(raw_calls(spark, folder)), LOOKUP_PREFIX)
    return _rounded(lookup.risk_info(history), ["confidence_score"])


# --- Duplicates and quality -------------------------------------------------


@_query("dedup_exact")
def _(spark, folder):
    return dedup.drop_exact_duplicates(raw_calls(spark, folder))


@_query("dedup_near")
def _(spark, folder):
    return dedup.dedup(timed_calls(spark, folder)).drop("ts")


@_query("dedup_report")
def _(spark, folder):
    return dedup.dedup_report(timed_calls(spark, folder))


@_query("dup_key_count")
def _(spark, folder):
    return dedup.duplicate_key_count(
        raw_calls(spark, folder), ["caller_number", "called_number", "timestamp", "duration_sec"]
    )


@_query("qa_checks")
def _(spark, folder):
    return quality.quality_checks(raw_calls(spark, folder))


@_query("csv_round_trip")
def _(spark, folder):
    """All calls written as CSV and read back."""
    path = f"{checkpoint_root(spark)}/csv-{uuid.uuid4().hex}"
    write_calls(raw_calls(spark, folder), path, "csv")
    return read_calls(spark, path, "csv")


@_query("days_replaced")
def _(spark, folder):
    """Calls laid out by date, of which one day is then replaced by its rows in standard spelling."""
    path = f"{checkpoint_root(spark)}/by-date-{uuid.uuid4().hex}"
    calls = timed_calls(spark, folder)
    write_calls(calls, path, by_date=True)
    day = F.to_date("ts") == F.lit(CORRECTED_DAY)
    replace_days(cleaning.clean_categories(calls).filter(day), path)
    return spark.read.schema(calls.schema).parquet(path).select(*CALL_COLUMNS)


@_query("checked_write")
def _(spark, folder):
    """The call table as it is read back after a write that had to pass the checks."""
    path = f"{checkpoint_root(spark)}/checked-{uuid.uuid4().hex}"
    quality.write_checked(raw_calls(spark, folder), path, (1, float("inf")), (0.3, 0.5))
    return spark.read.parquet(path)


@_query("qa_checks_odd_labels")
def _(spark, folder):
    """The same checks on calls of which one label is misspelt."""
    odd = F.when(F.col("label_5way") == "Unknown", F.lit(" Un-Known ")).otherwise(F.col("label_5way"))
    checks = quality.quality_checks(raw_calls(spark, folder).withColumn("label_5way", odd))
    return checks.filter("check_name = 'known_labels'")


@_query("qa_unknown_labels")
def _(spark, folder):
    # Two labels are taken off the allowed ones, so that there is something to find.
    return quality.unknown_labels(raw_calls(spark, folder), ["confirmed_fraud", "unknown", "verified_legitimate"])


@_query("null_profile")
def _(spark, folder):
    return quality.null_profile(raw_calls(spark, folder))


@_query("table_facts")
def _(spark, folder):
    return quality.table_facts(raw_calls(spark, folder))


# --- Exploration -----------------------------------------------------------


@_query("caller_profile")
def _(spark, folder):
    return _rounded(explore.caller_profile(clean_calls(spark, folder)), ["fraud_rate", "avg_duration_sec"])


@_query("top_suspicious")
def _(spark, folder):
    top = explore.top_suspicious(explore.caller_profile(clean_calls(spark, folder)))
    return _rounded(top, ["fraud_rate", "avg_duration_sec"])


@_query("top_suspicious_busy")
def _(spark, folder):
    top = explore.top_suspicious(explore.caller_profile(clean_calls(spark, folder)), min_calls=BUSY_CALLS)
    return _rounded(top, ["fraud_rate", "avg_duration_sec"])


@_query("caller_band")
def _(spark, folder):
    return explore.with_bands(explore.caller_profile(clean_calls(spark, folder))).select("caller_number", "band")


@_query("caller_pattern")
def _(spark, folder):
    return explore.with_bands(explore.caller_profile(clean_calls(spark, folder))).select("caller_number", "pattern")


@_query("pattern_summary")
def _(spark, folder):
    return explore.pattern_summary(explore.caller_profile(clean_calls(spark, folder)))


@_query("caller_counts")
def _(spark, folder):
    return explore.caller_counts(explore.caller_profile(clean_calls(spark, folder)), BUSY_CALLS)


@_query("call_heatmap")
def _(spark, folder):
    return explore.call_heatmap(clean_timed_calls(spark, folder))


@_query("call_heatmap_pivot")
def _(spark, folder):
    return explore.call_heatmap_pivot(clean_timed_calls(spark, folder))


@_query("behavior_share")
def _(spark, folder):
    shares = explore.behavior_share(raw_calls(spark, folder), texts.canonical_label(F.col("label_5way")))
    return _rounded(shares, ACTION_FLAGS, 3)


@_query("subsequent_events")
def _(spark, folder):
    shares = explore.subsequent_events(clean_calls(spark, folder))
    return _rounded(shares, [c for c in shares.columns if c.endswith("_1h")])


@_query("keyword_counts")
def _(spark, folder):
    return explore.keyword_counts(clean_calls(spark, folder)).withColumnsRenamed(KEYWORD_COLUMNS)


@_query("keyword_share")
def _(spark, folder):
    shares = explore.keyword_shares(explore.keyword_counts(clean_calls(spark, folder)))
    return _rounded(shares.withColumnsRenamed(KEYWORD_COLUMNS), KEYWORD_COLUMNS.values())


@_query("keyword_lift")
def _(spark, folder):
    return explore.keyword_lift(explore.keyword_counts(clean_calls(spark, folder)))


@_query("feature_corr")
def _(spark, folder):
    floats = feat.add_temporal_floats(clean_timed_calls(spark, folder))
    names = ["hour", "weekday", "is_business_hours", "is_weekend", "time_to_next_action_min", "time_to_next_action_sec"]
    return _rounded(explore.feature_correlations(floats, names, risk.fraud_flag(F.col("label_5way"))), ["correlation"])


@_query("label_counts")
def _(spark, folder):
    calls = raw_calls(spark, folder)
    spelled = explore.value_counts(calls, "label_5way", "label").withColumn("spelling", F.lit("raw"))
    canonical = explore.value_counts(calls, texts.canonical_label(F.col("label_5way")), "label")
    return spelled.unionByName(canonical.withColumn("spelling", F.lit("canonical")))


@_query("channel_counts")
def _(spark, folder):
    return explore.value_counts(clean_calls(spark, folder), "channel", "channel")


@_query("target_summary")
def _(spark, folder):
    return _rounded(cleaning.target_summary(clean_calls(spark, folder)), ["share"])


@_query("top_numbers")
def _(spark, folder):
    top = explore.top_numbers(cleaning.build_targets(clean_calls(spark, folder)))
    return _rounded(top, ["fraud_rate"])


@_query("fraud_by_hour")
def _(spark, folder):
    timed = feat.add_temporal_features(cleaning.build_targets(clean_timed_calls(spark, folder)))
    return _rounded(explore.fraud_by_hour(timed), ["fraud_rate"])


@_query("number_risk")
def _(spark, folder):
    return _rounded(lookup.number_risk(load_calls(raw_calls(spark, folder))), ["confidence_score"])


@_query("risk_level")
def _(spark, folder):
    score = F.col("confidence_score")
    return raw_calls(spark, folder).select(
        "call_id", risk.risk_level(score).alias("level"), risk.probability_band(score).alias("band")
    )


@_query("history_summary")
def _(spark, folder):
    history = lookup.matching_calls(cleaning.clean_categories(load_calls(raw_calls(spark, folder))), LOOKUP_PREFIX)
    return lookup.history_summary(history)


@_query("filter_options")
def _(spark, folder):
    return explore.filter_options(clean_calls(spark, folder))


@_query("date_range")
def _(spark, folder):
    dates = explore.date_range(timed_calls(spark, folder))
    return dates.select(*[F.col(c).cast("string").alias(c) for c in dates.columns])


@_query("top_volume")
def _(spark, folder):
    return _rounded(explore.top_volume(raw_calls(spark, folder)), ["fraud_rate"])


@_query("fraud_label_share")
def _(spark, folder):
    return _rounded(explore.fraud_label_share(clean_calls(spark, folder)), ["fraud_rate"])


@_query("median_profile")
def _(spark, folder):
    names = ["duration_sec", "time_to_next_action_min", "manual_severity", "confidence_score"]
    return _rounded(ordered.exact_medians(raw_calls(spark, folder), names), ["median"])


@_query("median_sketches")
def _(spark, folder):
    """Whether medians merged from daily sketches have a rank within the stated error of the middle."""
    names = ["duration_sec", "time_to_next_action_min", "manual_severity", "confidence_score"]
    calls = timed_calls(spark, folder)
    daily = store(ordered.median_sketches(calls.withColumn("day", F.to_date("ts")), names, ["day"]), "daily-sketches")
    found = store(ordered.sketched_medians(daily), "sketched-medians").withColumnRenamed("n", "n_sketched")
    values = calls.select(*names).unpivot([], names, "column", "value").filter("value is not null")
    # One row per column.
    ranked = values.join(F.broadcast(found), "column").groupBy("column", "n_sketched")
    counts = ranked.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("value") < F.col("median")).alias("below"),
        F.count_if(F.col("value") <= F.col("median")).alias("upto"),
    )
    error = SKETCH_RANK_ERROR
    near = (F.col("below") <= (0.5 + error) * F.col("n")) & (F.col("upto") >= (0.5 - error) * F.col("n"))
    return counts.select("column", "n", (near & (F.col("n") == F.col("n_sketched"))).alias("within"))


@_query("label_medians")
def _(spark, folder):
    medians = ordered.exact_medians(clean_calls(spark, folder), ["time_to_next_action_min"], ["label_5way"])
    return _rounded(medians, ["median"]).drop("column")


@_query("top_k")
def _(spark, folder):
    return explore.top_k(raw_calls(spark, folder), 20, "time_to_next_action_min", ["call_id", "duration_sec"]).select(
        "call_id", "time_to_next_action_min"
    )


@_query("top_risk_calls")
def _(spark, folder):
    return explore.top_risk_calls(dedup.drop_exact_duplicates(clean_timed_calls(spark, folder)))


# --- Windows and features ---------------------------------------------------


def _trailing(spark: SparkSession, folder: str) -> DataFrame:
    labelled = prepare.labelled_table(raw_calls(spark, folder))
    return _rounded(trailing.add_trailing_features(labelled), [trailing.MEAN_DURATION])


@_query("calls_last_24h")
def _(spark, folder):
    return _trailing(spark, folder).select("call_id", trailing.CALLS_24H)


@_query("victims_last_7d")
def _(spark, folder):
    return _trailing(spark, folder).select("call_id", trailing.VICTIMS_7D)


@_query("mean_duration_per_number")
def _(spark, folder):
    means = trailing.add_mean_duration(raw_calls(spark, folder)).select("call_id", trailing.MEAN_DURATION)
    return _rounded(means, [trailing.MEAN_DURATION])


@_query("behavioral_features")
def _(spark, folder):
    return _trailing(spark, folder).select("call_id", *TRAILING_FEATURES)


@_query("frequency_encode")
def _(spark, folder):
    return feat.frequency_encode(raw_calls(spark, folder), "called_number").select("call_id", "called_number_freq")


@_query("time_split")
def _(spark, folder):
    return feat.add_time_split(prepare.labelled_table(raw_calls(spark, folder))).select("call_id", "split")


@_query("split_drift")
def _(spark, folder):
    split = feat.add_time_split(prepare.labelled_table(raw_calls(spark, folder)))
    return _rounded(feat.split_drift(split), ["train_rate", "test_rate", "gap_pp"])


@_query("stratified_split")
def _(spark, folder):
    labelled = prepare.labelled_table(raw_calls(spark, folder))
    return feat.stratified_split(labelled).select("call_id", "is_fraud", "split")


@_query("build_targets")
def _(spark, folder):
    return cleaning.build_targets(clean_calls(spark, folder)).select("call_id", "duration_sec", "label_5way", "is_fraud")


@_query("impute_documented")
def _(spark, folder):
    return feat.impute_documented(raw_calls(spark, folder)).select(
        "call_id", "duration_sec", "manual_severity", "time_to_next_action_min", "channel", "complaint_text", *ACTION_FLAGS
    )


@_query("impute_train_median")
def _(spark, folder):
    split = feat.add_time_split(prepare.labelled_table(raw_calls(spark, folder)))
    names = ["duration_sec", "time_to_next_action_min", "manual_severity"]
    return feat.impute_train_median(split, names).select("call_id", "split", *names)


@_query("onehot_channel")
def _(spark, folder):
    return feat.one_hot_channel(clean_calls(spark, folder)).select("call_id", "channel_Mobile", "channel_VoIP")


@_query("feature_matrix")
def _(spark, folder):
    timed = feat.add_temporal_features(labelled_calls(spark, folder))
    return feat.build_features(timed, keep=("call_id",)).drop("ts")


@_query("standard_scale")
def _(spark, folder):
    data = prepare.training_table(raw_calls(spark, folder))
    names = feat.columns_to_scale(data.table, not_features=prepare.KEPT)
    scaled = feat.scale(data.table, feat.fit_scaling(data.train, names))
    return _rounded(scaled, names).select("call_id", *names)


@_query("prepare_dataset")
def _(spark, folder):
    return _rounded(prepare.prepare_dataset(raw_calls(spark, folder)), SCALED_FEATURES)


@_query("prepare_dataset_train_only")
def _(spark, folder):
    return _rounded(prepare.prepare_dataset(raw_calls(spark, folder), fit_on_train=True), SCALED_FEATURES)


@_query("prepare_behavioral")
def _(spark, folder):
    return _rounded(prepare.prepare_behavioral(raw_calls(spark, folder)), [trailing.MEAN_DURATION])


@_query("class_weights")
def _(spark, folder):
    return _rounded(feat.class_weights(cleaning.build_targets(clean_calls(spark, folder))), ["weight"])


# --- Evaluation of a rule that needs no training -----------------------------


def rule_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled calls with the share of risky actions that followed as a score."""
    calls = cleaning.build_targets(clean_calls(spark, folder))
    actions = [F.col(c).cast("int") for c in ACTION_FLAGS]
    return calls.withColumn("score", sum(actions[1:], actions[0]) / len(actions)).withColumn(
        "prediction", (F.col("score") >= 0.4).cast("int")
    )


@_query("eval_metrics")
def _(spark, folder):
    return _rounded(evaluate.classification_metrics(rule_scored(spark, folder)), ["accuracy", "precision", "recall", "f1"])


@_query("roc_auc")
def _(spark, folder):
    return _rounded(evaluate.roc_auc(rule_scored(spark, folder)), ["roc_auc"])


@_query("roc_auc_continuous")
def _(spark, folder):
    calls = cleaning.build_targets(clean_calls(spark, folder)).filter(F.col("time_to_next_action_min").isNotNull())
    return _rounded(evaluate.roc_auc(calls.withColumn("score", -F.col("time_to_next_action_min"))), ["roc_auc"])


@_query("confusion_matrix")
def _(spark, folder):
    return evaluate.confusion_matrix(rule_scored(spark, folder))


@_query("class_report")
def _(spark, folder):
    return _rounded(evaluate.class_report(rule_scored(spark, folder)), ["precision", "recall", "f1"])


@_query("single_feature_auc")
def _(spark, folder):
    data = prepare.training_table(raw_calls(spark, folder))
    return _rounded(audits.single_feature_auc(data.train, data.test, BASE_FEATURES), ["roc_auc"])


# --- Models -----------------------------------------------------------------


def _data(spark: SparkSession, folder: str, behavioral: bool = False) -> prepare.Prepared:
    return prepare.training_table(raw_calls(spark, folder), behavioral)


def _logistic(data: prepare.Prepared, **options) -> models.Fitted:
    return models.fit_logistic(data.train, data.features, **options)


def _forest(data: prepare.Prepared) -> models.Fitted:
    return models.fit_forest(data.train, data.features)


def _boosting(data: prepare.Prepared, **options) -> models.Fitted:
    return models.fit_boosting(data.train, data.features, **options)


def _tuned(data: prepare.Prepared) -> models.Fitted:
    """The published best point of the grid."""
    return _boosting(data, iterations=200, step=0.1, depth=2)


def _test_metrics(data: prepare.Prepared, fitted: models.Fitted) -> DataFrame:
    return models.scored_metrics(fitted.score(data.test), fitted.name)


@_query("train_logreg")
def _(spark, folder):
    data = _data(spark, folder)
    return _test_metrics(data, _logistic(data))


@_query("train_rf")
def _(spark, folder):
    data = _data(spark, folder)
    return _test_metrics(data, _forest(data))


@_query("train_gbt")
def _(spark, folder):
    data = _data(spark, folder)
    return _test_metrics(data, _boosting(data))


@_query("train_gbt_behavioral")
def _(spark, folder):
    data = _data(spark, folder, behavioral=True)
    return _test_metrics(data, _tuned(data))


@_query("grid_search")
def _(spark, folder):
    """Every point by its area; the best one is refitted on all training calls and measured on the test part."""
    data = _data(spark, folder)
    ranked, best = models.grid_search(data.train, data.features)
    return models.refit_report(ranked, _test_metrics(data, best))


@_query("trained_facts")
def _(spark, folder):
    """What must hold for each trained model: every test call scored, probabilities, an area far above chance."""
    data = _data(spark, folder)
    members = [*train.fit_all(data), models.fit_boosting(data.train, data.features, 200, 0.1, 2, name="tuned")]
    scored = data.test
    for member in members:
        scored = member.score(scored)
    names = [m.name for m in members]
    scored = store(scored.select("is_fraud", *[f"{n}_{c}" for n in names for c in ("p", "prediction")]), "trained-scores")
    outside = scored.select(*[(~F.col(f"{n}_p").between(0, 1)).cast("int").alias(n) for n in names])
    counts = outside.unpivot([], names, "model", "outside").groupBy("model").agg(
        F.count("outside").alias("n_scored"), F.sum("outside").alias("n_outside")
    )
    # One row per model on either side.
    both = counts.join(models.compare_models(scored, names).select("model", "roc_auc"), "model")
    return both.select("model", "n_scored", "n_outside", (F.col("roc_auc") >= 0.9).alias("area_reached"))


@_query("saved_scores")
def _(spark, folder):
    """Test calls whose score differs between a model and what is loaded of it after saving: none."""
    data = _data(spark, folder)
    fitted = _logistic(data)
    path = f"{checkpoint_root(spark)}/saved-{uuid.uuid4().hex}"
    models.save_model(fitted, path)
    before = fitted.score(data.test).withColumnRenamed(f"{fitted.name}_p", "before").drop(f"{fitted.name}_prediction")
    after = models.load_model(path).score(before)
    same = F.col("before").eqNullSafe(F.col(f"{fitted.name}_p"))
    return after.agg(F.count(F.lit(1)).alias("n_calls"), F.count_if(~same).alias("n_different"))


@_query("coefficient_scores")
def _(spark, folder):
    """Test calls whose probability is not what the reported coefficients give: none."""
    data = _data(spark, folder)
    fitted = _logistic(data, fill="zero")
    both = models.coefficient_scores(fitted.score(data.test), fitted)
    off = F.abs(F.col("coefficient_p") - F.col(f"{fitted.name}_p")) > 1e-9
    return both.agg(F.count("coefficient_p").alias("n_calls"), F.count_if(off).alias("n_different"))


@_query("importance_facts")
def _(spark, folder):
    """What must hold for the importances of the forest: every feature once on both sides, a total of one."""
    report = train.importance_report(_data(spark, folder))
    joined = report["comparison"]
    return joined.agg(
        F.count_distinct("feature").alias("n_features"),
        F.count("importance_perm").alias("n_permuted"),
        F.count("importance_rf").alias("n_impurity"),
        F.round(F.sum("importance_rf"), 6).alias("total"),
        F.count_if(F.col("importance_rf") < 0).alias("n_negative"),
    )


# The model stage on two scores that need no training, so that plain SQL can follow it.


def fixed_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled calls as two models would leave them: the share of actions, and a line in the time to act."""
    calls = labelled_calls(spark, folder)
    actions = [F.col(c).cast("int") for c in ACTION_FLAGS]
    line = F.greatest(F.lit(0.0), 1 - F.coalesce(F.col("time_to_next_action_min"), F.lit(60.0)) / 120)
    return calls.withColumns({"rule_p": sum(actions[1:], actions[0]) / len(actions), "line_p": line}).withColumns(
        {"rule_prediction": (F.col("rule_p") > 0.5).cast("int"), "line_prediction": (F.col("line_p") > 0.5).cast("int")}
    )


@_query("soft_vote_fixed")
def _(spark, folder):
    voted = models.vote(fixed_scored(spark, folder), ["rule", "line"])
    return _rounded(models.compare_models(voted, ["rule", "line", "vote"]), evaluate.METRICS)


@_query("best_model_fixed")
def _(spark, folder):
    names = ["rule", "line"]
    marked = models.mark_best(models.compare_models(fixed_scored(spark, folder), names), names)
    return _rounded(marked, evaluate.METRICS)


@_query("metric_delta_fixed")
def _(spark, folder):
    table = _rounded(models.compare_models(fixed_scored(spark, folder), ["rule", "line"]), evaluate.METRICS)
    before, after = (table.filter(F.col("model") == n).drop("model") for n in ("rule", "line"))
    return _rounded(evaluate.metric_delta(before, after), ["delta"])


@_query("score_calls_fixed")
def _(spark, folder):
    return models.call_scores(fixed_scored(spark, folder), "line")


@_query("label_permutation_fixed")
def _(spark, folder):
    return _rounded(
        audits.label_permutation(fixed_scored(spark, folder), "line_p"),
        ["base_auc", "shuffled_mean_auc", "shuffled_std_auc"],
    )


# Valid in either SQL.
FIXED_FEATURES = ["time_to_next_action_min", "login_after_call", "transfer_after_call"]
FIXED_SCORE = (
    "(greatest(0, 1 - coalesce(time_to_next_action_min, 60) / 120) + cast(login_after_call as int) "
    "+ cast(transfer_after_call as int)) / 3"
)


@_query("permutation_importance_fixed")
def _(spark, folder):
    fixed = models.FixedScore("fixed", FIXED_FEATURES, FIXED_SCORE)
    return _rounded(audits.permutation_importance(labelled_calls(spark, folder), fixed), ["importance", "std"])


@_query("top_importances_fixed")
def _(spark, folder):
    """The first two features by importance."""
    fixed = models.FixedScore("fixed", FIXED_FEATURES, FIXED_SCORE)
    found = audits.permutation_importance(labelled_calls(spark, folder), fixed)
    return explore.top_k(_rounded(found, ["importance", "std"]), 2, "importance", ["feature"])


@_query("logreg_gradient")
def _(spark, folder):
    data = _data(spark, folder)
    return _rounded(models.logistic_gradient(data.train, _logistic(data)), ["gradient"], 4)


@_query("soft_vote")
def _(spark, folder):
    data = _data(spark, folder)
    voted = models.soft_vote(data.test, train.fit_all(data))
    return models.compare_models(voted, ["logistic", "forest", "boosting", "vote"])


@_query("model_comparison")
def _(spark, folder):
    data = _data(spark, folder)
    return train.model_comparison(data, train.fit_all(data))


@_query("best_model")
def _(spark, folder):
    data = _data(spark, folder)
    path = f"{checkpoint_root(spark)}/best-model-{uuid.uuid4().hex}"
    return train.save_best(data, train.fit_all(data), path)


@_query("metric_delta")
def _(spark, folder):
    before, after = _data(spark, folder), _data(spark, folder, behavioral=True)
    return evaluate.metric_delta(
        _test_metrics(before, _boosting(before)).drop("model"), _test_metrics(after, _tuned(after)).drop("model")
    )


@_query("score_calls")
def _(spark, folder):
    data = _data(spark, folder)
    return models.score_calls(data.table, _logistic(data))


@_query("rf_importance")
def _(spark, folder):
    data = _data(spark, folder)
    return models.impurity_importance(data.table, _forest(data))


@_query("permutation_importance")
def _(spark, folder):
    return train.importance_report(_data(spark, folder))["permutation"]


@_query("compare_importances")
def _(spark, folder):
    return train.importance_report(_data(spark, folder))["comparison"]


@_query("label_permutation")
def _(spark, folder):
    data = _data(spark, folder)
    fitted = _logistic(data, fill="zero")
    return audits.label_permutation(fitted.score(data.test), f"{fitted.name}_p")


@_query("label_permutation_gbt")
def _(spark, folder):
    data = _data(spark, folder)
    fitted = _boosting(data, fill="zero")
    return audits.label_permutation(fitted.score(data.test), f"{fitted.name}_p")


@_query("gbt_importance")
def _(spark, folder):
    data = _data(spark, folder)
    return models.impurity_importance(data.table, _boosting(data))


@_query("coef_report")
def _(spark, folder):
    data = _data(spark, folder)
    return models.coefficient_report(data.table, _logistic(data, fill="zero"))


@_query("score_stream")
def _(spark, folder):
    """Calls arrive as files and are scored by a model that was saved before."""
    root = f"{checkpoint_root(spark)}/score-stream-{uuid.uuid4().hex}"
    data = _data(spark, folder)
    train.save_for_scoring(data, _logistic(data), f"{root}/job")
    raw_calls(spark, folder).write.parquet(f"{root}/arriving")
    fitted, counts = train.load_for_scoring(spark, f"{root}/job")
    scores = scoring.score_stream(scoring.read_call_stream(spark, f"{root}/arriving"), fitted, counts)
    scoring.write_scores(scores, f"{root}/scores", f"{root}/progress").awaitTermination()
    return spark.read.parquet(f"{root}/scores")


@_query("stream_features")
def _(spark, folder):
    """What the stream gives its model for each arriving call, without the model."""
    root = f"{checkpoint_root(spark)}/stream-features-{uuid.uuid4().hex}"
    raw = raw_calls(spark, folder)
    prepare.feature_table(prepare.labelled_table(raw)).counts.write.parquet(f"{root}/prefixes")
    raw.write.parquet(f"{root}/arriving")
    arriving = scoring.read_call_stream(spark, f"{root}/arriving")
    rows = scoring.live_features(arriving, spark.read.parquet(f"{root}/prefixes"))
    scoring.write_scores(rows, f"{root}/features", f"{root}/progress").awaitTermination()
    return spark.read.parquet(f"{root}/features").select("call_id", "caller_number", "ts", *BASE_FEATURES)


def _arriving(spark: SparkSession, calls: DataFrame, root: str, days: int, run: Callable[[DataFrame], StreamingQuery]) -> None:
    """Let ``calls`` arrive in files of ``days`` days each, in time order, and run a stream after each arrival.

    Calls without time come with the first files.
    """
    first, last = calls.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    starts = [first + dt.timedelta(days=k) for k in range(0, (last - first).days + 1, days)]
    schema = calls.schema
    for k, start in enumerate(starts):
        day = F.to_date("ts")
        mine = (day >= F.lit(start)) & (day < F.lit(start + dt.timedelta(days=days)))
        calls.filter(mine | day.isNull() if k == 0 else mine).write.mode("append").parquet(f"{root}/arriving")
        run(spark.readStream.schema(schema).parquet(f"{root}/arriving")).awaitTermination()


@_query("stream_trailing")
def _(spark, folder):
    """Behavioral features of calls that arrive five days at a time, from what is carried over."""
    root = f"{checkpoint_root(spark)}/stream-trailing-{uuid.uuid4().hex}"
    calls = store(prepare.labelled_table(raw_calls(spark, folder)), "stream-calls")
    step = carried.trailing_step(calls)
    _arriving(spark, calls, root, 5, lambda s: carried.write_carried(s, step, f"{root}/out", f"{root}/open", f"{root}/progress"))
    found = _rounded(spark.read.parquet(f"{root}/out"), [trailing.MEAN_DURATION])
    return found.select("call_id", *TRAILING_FEATURES)


@_query("stream_dedup")
def _(spark, folder):
    """Exact and near duplicates dropped from calls that arrive five days at a time."""
    root = f"{checkpoint_root(spark)}/stream-dedup-{uuid.uuid4().hex}"
    calls = store(timed_calls(spark, folder), "stream-calls")
    step = carried.dedup_step()
    _arriving(spark, calls, root, 5, lambda s: carried.write_carried(s, step, f"{root}/out", f"{root}/open", f"{root}/progress"))
    last = spark.read.parquet(f"{root}/open").agg(F.max("batch")).first()[0]
    left = carried.close_carried(spark.read.parquet(f"{root}/open/batch={last}"))
    return spark.read.parquet(f"{root}/out").drop("batch").unionByName(left).drop("ts")


@_query("stream_dedup_exact")
def _(spark, folder):
    """Exact repeats dropped by a stream with watermarked state, over calls that arrive five days at a time."""
    root = f"{checkpoint_root(spark)}/stream-exact-{uuid.uuid4().hex}"
    calls = store(timed_calls(spark, folder), "stream-calls")

    def run(arriving: DataFrame) -> StreamingQuery:
        once = scoring.drop_repeated_calls(arriving.drop("ts"))
        return scoring.write_scores(once, f"{root}/out", f"{root}/progress")

    _arriving(spark, calls, root, 5, run)
    return spark.read.parquet(f"{root}/out")
