"""Quality rules against plain counts; verdicts on labelled documents."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import no_rows, odd_rows
from ringwatch.llm.quality_rules import HELD_SHARE, MIN_SCORE, STEP, gather, held_out, judge_quality, keep_quality, log_ratios, ngram_counts
from ringwatch.llm.wordbpe import Cached
from ringwatch.llm.words import following, hashed, repeated_windows, word_hash

SPACE = " \t\n\x0b\x0c\r"


def plain_words(text):
    for c in SPACE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_counts(text):
    text = text or ""
    words = plain_words(text)
    lines = [line for line in text.split("\n") if plain_words(line)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(8)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:k] for k, line in enumerate(lines)),
        len(covered),
    )


def counts_of(row):
    return tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))


def plain_limit(scores):
    """The limit from the scores of held-out documents: at most a share of them lies below, in whole steps."""
    steps = sorted(math.floor(s / STEP) for s in scores)
    return min(MIN_SCORE, steps[math.floor(HELD_SHARE * len(steps))] * STEP) if steps else MIN_SCORE


def split_ids(trusted):
    """The trusted ids that are counted, and those that are held out."""
    rows = trusted.toDF("id").select("id", held_out(F.col("id")).alias("held")).collect()
    return {r["id"] for r in rows if not r["held"]}, {r["id"] for r in rows if r["held"]}


def test_counts_on_the_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    trusted = spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1").select("doc_id")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = judge_quality(docs, trusted).collect()
    assert len(rows) == len(texts)
    counted, held = split_ids(trusted)
    assert len(held) and len(counted) > 4 * len(held)
    limit = plain_limit([r["score"] for r in rows if r["doc_id"] in held and not r["base_failed"]])
    for r in rows:
        want = plain_counts(texts[r["doc_id"]])
        assert counts_of(r) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= limit)
    kept = keep_quality(docs, trusted)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in rows if r["kept"])


def test_clean_documents_stay_and_junk_goes(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    # Only a half of the good documents is trusted, the verdict is on the others.
    judged = judge_quality(
        spark.read.parquet(f"{folder}/documents.parquet"), labels.filter("quality = 1 and doc_id % 2 = 0").select("doc_id")
    ).join(labels.filter("not (quality = 1 and doc_id % 2 = 0)"), "doc_id")
    rows = judged.filter("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.97
    assert np.mean(bad) < 0.3


@pytest.mark.parametrize("seed", range(30))
def test_repeated_windows(seed):
    rng = random.Random(seed)
    words = [rng.choice([b"a", b"b"]) for _ in range(rng.randint(0, 60))]
    hashes = hashed(words, Cached(word_hash))
    assert repeated_windows(hashes, words, 8) == plain_counts(b" ".join(words).decode())[4]


def test_counts_and_ratios(spark):
    held, known = (spark.range(1, 100).filter(c).first()[0] for c in (held_out(F.col("id")), ~held_out(F.col("id"))))
    docs = spark.createDataFrame([(known, "a b a"), (held, "b b"), (200, None), (None, "b")], "doc_id long, text string")
    trusted = spark.createDataFrame([(known,), (None,), (known,), (held,)], "id long")
    gathered = gather(docs, trusted, "doc_id", "text", (1,), 16)
    assert [r["text"] for r in gathered.filter("bucket is null").collect()] == ["b b"]
    rows = {r["bucket"]: (r["trusted"], r["raw"]) for r in ngram_counts(gathered).collect()}

    def bucket(w):
        return int(following(np.array([word_hash(w)], dtype=np.uint64), 1)[0] >> np.uint64(48))

    assert rows == {bucket(b"a"): (2, 2), bucket(b"b"): (1, 4)}
    table = spark.createDataFrame([(0, 6, 6), (1, 0, 6)], "bucket long, trusted long, raw long")
    ratios = log_ratios(table, 4)
    assert ratios[0] == pytest.approx(np.log(16 / 13)) and ratios[1] == pytest.approx(np.log(10 / 13))
    assert not ratios[2:].any()
    assert not log_ratios(table.limit(0), 4).any()


def test_the_limit_falls_where_clean_text_scores_low(spark):
    """A table of copies of few documents: clean text that was held out shares no n-gram with what was counted."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(160)]
    docs = spark.createDataFrame([(k, texts[k % 160]) for k in range(160 * 30)], "doc_id long, text string")
    # Of one half of the texts only counted copies are trusted, of the other half only copies that are held out.
    trusted = docs.filter((F.col("doc_id") % 160 >= 80) == held_out(F.col("doc_id"))).select("doc_id")
    rows = judge_quality(docs, trusted).collect()
    counted, held = split_ids(trusted)
    limit = plain_limit([r["score"] for r in rows if r["doc_id"] in held])
    assert limit < MIN_SCORE
    assert all(r["kept"] == (r["score"] >= limit) for r in rows)
    assert all(r["kept"] for r in rows if r["doc_id"] in held)


def test_odd_rows(spark):
    docs = odd_rows(spark)
    trusted = spark.createDataFrame([(1,), (None,), (1,)], "doc_id long")
    rows = judge_quality(docs, trusted).collect()
    assert sorted(counts_of(r) for r in rows) == sorted(plain_counts(r["text"]) for r in docs.collect())
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] == 0)
    kept = keep_quality(docs, trusted)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in rows)


def test_empty_tables(spark):
    nobody = spark.createDataFrame([], "doc_id long")
    assert judge_quality(no_rows(spark), nobody).count() == 0
    docs = odd_rows(spark)
    assert {r["score"] for r in judge_quality(docs, nobody).collect()} == {0.0}
