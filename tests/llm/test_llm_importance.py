"""Span checksums against zlib, resampling against a plain computation."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_cases import no_rows, odd_rows
from ringwatch.llm.importance import importance_resample
from ringwatch.llm.span_crc import REACH, span_crcs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    runs = [" ".join(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]
    return len(words), Counter(zlib.crc32(r.encode()) % 10000 for r in runs)


def plain_resample(docs, target, percent=5, min_words=20):
    made = [(doc, *plain_features(text)) for doc, text in docs]
    s, t = sum((c for _, _, c in made), Counter()), sum((plain_features(x)[1] for x in target), Counter())
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10000.0) / ((s[b] + 1.0) * (all_t + 10000.0))))

    rows = []
    for doc, words, features in made:
        weight = sum(n * gain(b) for b, n in features.items())
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([doc, words, sum(features.values()), weight, weight + noise, None])
    rows.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1], r[2], r[3]))
    able = [r for r in rows if r[1] >= min_words]
    for k, row in enumerate(able[: percent * len(able) // 100]):
        row[5] = k + 1
    return sorted(map(tuple, rows), key=repr)


def resample(docs, target, **options):
    return sorted(map(tuple, importance_resample(docs, target, **options).collect()), key=repr)


def test_checksums_of_spans():
    rng = np.random.default_rng(4)
    data = rng.integers(0, 256, 60_000).astype(np.uint8)
    start = rng.integers(0, 50_000, 3000)
    length = np.minimum(rng.zipf(1.25, 3000), 9000)
    length[:200] = np.arange(200) + 1
    length[200:206] = [REACH - 1, REACH, REACH + 1, 2 * REACH, 2 * REACH + 1, 9999]
    want = [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(start, length)]
    assert span_crcs(data, start, length).tolist() == want
    assert len(span_crcs(data, start[:0], length[:0])) == 0


def corpus(n, seed=2):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "dé", "x" * 70, "7th", "中文", "o", "end"]
    docs = [(k, rng.choice([" ", "-", ".\n"]).join(rng.choices(words, k=rng.randint(0, 60)))) for k in range(n)]
    return docs, [" ".join(rng.choices(words[:3], k=9)) for _ in range(5)]


@pytest.mark.parametrize("percent", [5, 60])
def test_same_as_plain(spark, percent):
    docs, target = corpus(300)
    docs += docs[:9] + [(None, docs[1][1]), (None, None), (4, docs[8][1] + " more"), (500, "z" * 5000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    want = plain_resample(docs, target, percent)
    assert resample(df, bench, percent=percent) == want
    assert sum(r[-1] is not None for r in want) > 5


def test_odd_rows(spark):
    docs = odd_rows(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for target in (["alpha beta alpha"], [None, ""], []):
        bench = spark.createDataFrame([(t,) for t in target], "text string")
        assert resample(docs, bench, percent=100, min_words=1) == plain_resample(rows, target, 100, 1)


def test_empty_table(spark):
    assert importance_resample(no_rows(spark), no_rows(spark)).count() == 0
