"""From raw calls to training tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ringwatch.operators import features as feat
from ringwatch.operators.cleaning import build_targets, clean_categories
from ringwatch.operators.dedup import dedup
from ringwatch.operators.trailing import add_trailing_features
from ringwatch.schema import BASE_FEATURES, BEHAVIORAL_FEATURES
from ringwatch.session import store
from ringwatch.sources.calls import with_parsed_time

KEPT = ["call_id", "ts", "split", "is_fraud"]


def clean_table(raw: DataFrame) -> DataFrame:
    """Raw calls with parsed time, without duplicates, categories in standard spelling."""
    return clean_categories(dedup(with_parsed_time(raw)))


def labelled_table(raw: DataFrame) -> DataFrame:
    """Clean calls with a clear label and their target, written once as a stage boundary."""
    return store(build_targets(clean_table(raw)), "labelled-calls")


@dataclass
class Prepared:
    """A feature table with its split; ``features`` in model order, ``counts`` the calls per prefix it was given."""

    table: DataFrame
    features: list[str]
    counts: DataFrame

    @property
    def train(self) -> DataFrame:
        return self.table.filter("split = 'train'")

    @property
    def test(self) -> DataFrame:
        return self.table.filter("split = 'test'")


def feature_table(
    labelled: DataFrame, behavioral: bool = False, fit_on_train: bool = False
) -> Prepared:
    """Split by time and derive the features, unscaled.

    By default prefix counts and mean durations come from all labelled calls;
    ``fit_on_train`` takes them from the training part, so that nothing of the
    test part flows back.
    """
    split = feat.add_time_split(labelled)
    known = split.filter("split = 'train'") if fit_on_train else None
    wide = feat.add_temporal_features(split)
    if behavioral:
        wide = add_trailing_features(wide, known)
    counts = feat.prefix_counts(labelled if known is None else known)
    columns = BEHAVIORAL_FEATURES if behavioral else BASE_FEATURES
    table = feat.build_features(wide, keep=("call_id",), counts=counts).select(*KEPT, *columns)
    return Prepared(table, list(columns), counts)


def prepare_dataset(raw: DataFrame, fit_on_train: bool = False) -> DataFrame:
    """The whole preparation: both parts of the split, numbers scaled by the training part."""
    prepared = feature_table(labelled_table(raw), fit_on_train=fit_on_train)
    table = store(prepared.table, "features")
    train = table.filter("split = 'train'")
    columns = feat.columns_to_scale(table, not_features=KEPT)
    return feat.scale(table, feat.fit_scaling(train, columns))


def prepare_behavioral(raw: DataFrame, fit_on_train: bool = False) -> DataFrame:
    """The preparation with the trailing features, not scaled."""
    return feature_table(labelled_table(raw), behavioral=True, fit_on_train=fit_on_train).table


def training_table(raw: DataFrame, behavioral: bool = False, fit_on_train: bool = False) -> Prepared:
    """The unscaled feature table, written once, since every fit reads it many times."""
    prepared = feature_table(labelled_table(raw), behavioral, fit_on_train)
    return Prepared(store(prepared.table, "features"), prepared.features, prepared.counts)
