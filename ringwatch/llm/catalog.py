"""The registered queries of this subpackage, each one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.llm import oracle
from ringwatch.llm.alignment import align_tokenizers
from ringwatch.llm.decontamination import contamination_report
from ringwatch.llm.embedding_dups import embedding_groups
from ringwatch.llm.encoding import encoding_digests
from ringwatch.llm.ftrl import score_logistic
from ringwatch.llm.importance import importance_resample
from ringwatch.llm.mixing import mix
from ringwatch.llm.quality_rules import judge_quality
from ringwatch.llm.simhash import simhash_groups
from ringwatch.llm.templates import drop_repeated_lines
from ringwatch.llm.token_counts import count_tokens
from ringwatch.llm.toxicity import score_chain
from ringwatch.llm.warc import read_records, write_archive

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed package of public vocabularies has the file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def trusted_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that are labelled good."""
    return table(spark, folder, "labels").filter("quality = 1").select("doc_id")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge_quality(table(spark, folder, "documents"), trusted_ids(spark, folder))


def op2_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    archive = write_archive(table(spark, folder, "pages"))
    return read_records(spark, archive).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs, counts=True)


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), vocabulary_path())


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups(table(spark, folder, "documents"))


def op6_embedding_dups(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_groups(table(spark, folder, "embeddings"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The chain goes over both categories that are labelled: bad quality, then toxicity."""
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("id"), (1 - F.col("quality")).alias("low_quality"), "toxic"
    )
    return score_chain(table(spark, folder, "documents"), labels, ["low_quality", "toxic"])


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encoding_digests(table(spark, folder, "documents"), vocabulary_path(), words_kept=1 << 18)


def _held_out(column: str) -> Column:
    return F.crc32(F.col(column).cast("string")) % 3 == 1


def op10_quality_score(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    scored = score_logistic(table(spark, folder, "documents"), labels.filter(~_held_out("id")))
    return scored.select("doc_id", _held_out("doc_id").alias("held_out"), "score", "predicted")


def op11_fm_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination_report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = importance_resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    a_file, b_file = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
    return align_tokenizers(table(spark, folder, "documents"), a_file, b_file)


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_warc_archive": op2_warc_archive,
        "op3_line_templates": op3_line_templates,
        "op4_token_counts": op4_token_counts,
        "op5_simhash": op5_simhash,
        "op6_embedding_dups": op6_embedding_dups,
        "op7_toxicity": op7_toxicity,
        "op8_source_mix": op8_source_mix,
        "op9_bpe": op9_bpe,
        "op10_quality_score": op10_quality_score,
        "op11_fm_decontamination": op11_fm_decontamination,
        "op12_importance_resampling": op12_importance_resampling,
        "op13_tokenizer_alignment": op13_tokenizer_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
