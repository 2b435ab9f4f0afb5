"""A training-data pipeline over the documents table.

Five stages, each one operator; :func:`run` applies them one after the other, and a driver may
as well write each stage's result and read it again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.llm.catalog import table, trusted_ids, vocabulary_path
from ringwatch.llm.encoding import encoding_digests
from ringwatch.llm.mixing import mixed_rows
from ringwatch.llm.quality_rules import keep_quality
from ringwatch.llm.simhash import drop_near_copies
from ringwatch.llm.templates import drop_repeated_lines
from ringwatch.session import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_quality(docs, trusted_ids(spark, sf_dir))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, but for the first; ``n_chars`` follows the text."""
    cleaned = drop_repeated_lines(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id."""
    return drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stays as often as the mix takes it."""
    return mixed_rows(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens and digests of each document that is left."""
    return encoding_digests(docs, vocabulary_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_dedup),
    ("source mix", source_mix),
    ("bpe", bpe),
]

#: XXH64 fingerprints, merges of a vocabulary and hashed n-grams are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
