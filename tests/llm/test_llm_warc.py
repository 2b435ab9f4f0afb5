"""The archive gives every record back."""

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ringwatch.llm.warc import base32_of_hex, read_records, write_archive


def plain(rows, min_bytes=0):
    first = {}
    for page_id, _, html in rows:
        body = (html or "").encode()
        if page_id is not None:
            first[body] = min(page_id, first.get(body, page_id))
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        revisit = len(body) >= min_bytes and body in first and first[body] != page_id
        out.append((page_id, len(body), digest, "revisit" if revisit else "response", first[body] if revisit else None))
    return sorted(out, key=repr)


def found(records):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[n] for n in names) for r in records), key=repr)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x"))


@pytest.mark.parametrize("min_bytes", [0, 10])
def test_round_trip(spark, min_bytes):
    random.seed(4)
    bodies = ["", "<p>hot</p>", "<p>é</p>", "x" * 40_000, "<i>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n</i>", None]
    rows = [(k, f"http://h/{k}", random.choices(bodies, weights=[1, 9, 2, 2, 2, 1])[0]) for k in range(200)]
    rows += [(500, None, "alone"), (501, "http://h/\r\nWARC-Type: revisit", "alone 2"), (None, "u", "<p>hot</p>"), (None, "u", "nobody")]
    archive = write_archive(pages(spark, rows), min_bytes=min_bytes)
    records = read_records(spark, archive).collect()
    assert found(records) == plain(rows, min_bytes)
    body_of = {(i, u): (h or "").encode() for i, u, h in rows}
    for r in records:
        head = bytes(r["header"]).decode()
        assert head.startswith("WARC/1.1\r\n") and head.endswith("\r\n\r\n") and head.count("\r\n\r\n") == 1
        block = bytes(r["payload"]) if r["record_type"] == "response" else b""
        assert f"Content-Length: {len(block)}\r\n" in head
        assert bytes(r["record"]) == bytes(r["header"]) + block + b"\r\n\r\n"
        if r["page_id"] is not None:
            assert bytes(r["payload"]) == next(b for (i, _), b in body_of.items() if i == r["page_id"])
    stored = spark.read.parquet(archive.payloads)
    assert stored.count() == len(set(body_of.values()))


def test_repeated_rows_are_responses(spark):
    rows = [(1, "u", "a"), (1, "u", "a"), (2, "u", "a")]
    assert found(read_records(spark, write_archive(pages(spark, rows))).collect()) == plain(rows)


def test_empty_table(spark):
    assert read_records(spark, write_archive(pages(spark, []))).count() == 0


def test_damage_is_found(spark, tmp_path):
    archive = write_archive(pages(spark, [(1, "u", "a"), (2, "u", "b")]), str(tmp_path / "archive"))
    bad = spark.read.parquet(archive.payloads).withColumn("payload", F.lit(b"other"))
    bad.write.parquet(str(tmp_path / "bad"))
    damaged = type(archive)(str(tmp_path / "bad"), archive.headers)
    with pytest.raises(Exception, match="damaged payload"):
        read_records(spark, damaged).select("page_id", "payload_bytes").collect()


def test_base32(spark):
    for text in ("", "a", "zz"):
        hexed = hashlib.sha1(text.encode()).hexdigest()
        got = spark.range(1).select(base32_of_hex(F.lit(hexed))).first()[0]
        assert got == base64.b32encode(bytes.fromhex(hexed)).decode()


def test_ids_of_any_text(spark):
    rows = [(i, "u", body) for body in ("a", "b") for i in ("a>b", "", "ä b+%2F", "z\r\nWARC-Type: response", " ")]
    rows = [(i + body if body == "b" else i, u, body) for i, u, body in rows]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    assert found(read_records(spark, write_archive(df)).collect()) == plain(rows)
