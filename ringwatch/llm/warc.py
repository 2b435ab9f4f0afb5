"""A content-addressed archive of WARC records.

An archive is two tables in one folder. ``payloads`` holds the bytes of each
different payload once, under their SHA-256 digest; ``headers`` holds the exact header
of every record with the digest of its payload. Records are put together by a join.
Digests are checked when payloads are written (equal digest, equal length and equal
second digest) and again when they are read (bytes hash to their key).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.session import checkpoint_root

#: Digits 0-9A-V of base 32 numbers and the letters that digests use for them.
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RESPONSE = "response"
REVISIT = "revisit"


@dataclass(frozen=True)
class Archive:
    """The two folders of a written archive."""

    payloads: str
    headers: str


def base32_of_hex(digest: Column) -> Column:
    """A hexadecimal SHA-1 as 32 letters: five bytes are eight letters, four times."""
    parts = [
        F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)
    ]
    return F.translate(F.concat(*parts), DIGITS, LETTERS)


def _checked(value: str) -> Column:
    """The one value of a group, or an error if it has two."""
    same = F.min(value) == F.max(value)
    return F.when(same, F.min(value)).otherwise(
        F.raise_error(F.lit(f"payloads of one SHA-256 digest differ in {value}"))
    )


def _urn(page: Column) -> Column:
    """An id in a header: encoded, so that no sign of it ends the field."""
    return F.concat(F.lit("<urn:page:"), F.url_encode(F.coalesce(page.cast("string"), F.lit(""))), F.lit(">"))


def write_archive(
    pages: DataFrame,
    folder: str | None = None,
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    id_column: str = "page_id",
    uri_column: str = "url",
    payload_column: str = "html",
) -> Archive:
    """Write one WARC record per row of ``pages`` and return where they are.

    Of the records with equal payloads of at least ``min_bytes`` bytes the one with the
    smallest id is the response and the others revisit it; smaller payloads are always
    responses. ``folder`` is a new folder that all executors share; by default one in
    the session's checkpoint folder.

    A null payload is an empty one; a null address gives an empty target. A null id comes
    after all others; rows that repeat the id and payload of a response are responses
    too. Line breaks in addresses are percent-encoded. Other columns are not read. An
    empty table gives an empty archive.
    """
    spark = pages.sparkSession
    folder = folder or f"{checkpoint_root(spark)}/warc-{uuid.uuid4().hex}"
    archive = Archive(f"{folder}/payloads", f"{folder}/headers")
    payload = F.coalesce(F.col(payload_column).cast("string"), F.lit("")).cast("binary")
    records = pages.select(
        F.col(id_column).alias("page_id"), F.col(uri_column).cast("string").alias("uri"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    # Copies meet in each task first, so that a payload of a third of all pages is moved once per task.
    once = records.select(
        "digest", "payload", "page_id", F.sha1("payload").alias("sha1"), F.length("payload").cast("long").alias("n_bytes")
    )
    once.groupBy("digest").agg(
        F.min("page_id").alias("response_id"),
        _checked("sha1").alias("sha1"),
        _checked("n_bytes").alias("n_bytes"),
        F.first("payload").alias("payload"),
    ).write.parquet(archive.payloads)

    known = spark.read.parquet(archive.payloads).select("digest", "response_id", "sha1", "n_bytes")
    found = records.select("page_id", "uri", "digest").join(known, "digest")
    page, first = F.col("page_id"), F.col("response_id")
    revisits = (F.col("n_bytes") >= min_bytes) & first.isNotNull() & ~page.eqNullSafe(first)
    uri = F.replace(F.replace(F.coalesce("uri", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    def lines(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    digest_line = lines("WARC-Payload-Digest: sha1:", base32_of_hex(F.col("sha1")), "\r\n")
    header = F.when(
        revisits,
        lines(
            "WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Refers-To: ", _urn(first), "\r\n",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n",
            "WARC-Record-ID: ", _urn(page), "\r\nWARC-Date: ", date, "\r\n", digest_line,
            "WARC-Target-URI: ", uri, "\r\nContent-Length: 0\r\n\r\n",
        ),
    ).otherwise(
        lines(
            "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: ", _urn(page), "\r\nWARC-Date: ", date, "\r\n",
            digest_line, "WARC-Target-URI: ", uri, "\r\nContent-Type: text/html\r\nContent-Length: ",
            F.col("n_bytes").cast("string"), "\r\n\r\n",
        )
    )
    found.select("page_id", header.cast("binary").alias("header"), "digest").write.parquet(archive.headers)
    return archive


def read_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """``digest, payload, payload_bytes, payload_digest``; fails if bytes do not hash to their key."""
    stored = spark.read.parquet(archive.payloads)
    true_digest = F.sha2("payload", 256)
    damaged = F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))
    return stored.select(
        F.when(true_digest == F.col("digest"), true_digest).otherwise(damaged).alias("digest"),
        "payload",
        F.length("payload").cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
    )


def read_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record again: page_id, record_type, refers_to, header, payload, record, payload_bytes, payload_digest.

    Type and reference are read from the header. ``payload`` is the full payload, of
    revisits too; ``record`` is what a WARC file has: the header, a response's payload,
    and two line breaks. Only the columns that are asked for are moved.
    """
    headers = spark.read.parquet(archive.headers)
    text = F.col("header").cast("string")
    refers = F.regexp_extract(text, r"^WARC/1\.1\r\nWARC-Type: revisit\r\nWARC-Refers-To: <urn:page:([^>]*)>", 1)
    kind = F.regexp_extract(text, r"^WARC/1\.1\r\nWARC-Type: (\w+)", 1)
    parsed = headers.select(
        "page_id",
        "header",
        "digest",
        kind.alias("record_type"),
        F.when(kind != RESPONSE, F.url_decode(refers)).cast(headers.schema["page_id"].dataType).alias("refers_to"),
    )
    block = F.when(F.col("record_type") == RESPONSE, F.col("payload")).otherwise(F.lit(b""))
    return (
        parsed.join(read_payloads(spark, archive), "digest")
        .withColumn("record", F.concat("header", block, F.lit(b"\r\n\r\n")))
        .drop("digest")
    )
