"""SimHash and its Golay keys against plain comparisons."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_cases import components, no_rows, odd_rows
from ringwatch.llm.components import connected_components
from ringwatch.llm.simhash import (
    drop_near_copies,
    fingerprint,
    home_codeword,
    near_codewords,
    near_fingerprints,
    simhash_groups,
)


def plain_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_equals_the_plain_one(spark, folder):
    texts = [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").limit(40).collect()]
    for text in [*texts, "", None, "one", "ONE Two", "É À b c\x0bd", "a b c " * 20_000]:
        assert fingerprint((text or "").encode()) == plain_fingerprint(text)


def test_spark_hashes_a_shingle_alike(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b ç"))).first()[0]
    assert row % 2**64 == xxhash.xxh64_intdigest("a b ç".encode(), 42)


def test_codewords_within_reach():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 23, 3000)
    _, counts = np.unique(near_codewords(x)[0], return_counts=True)
    assert set(counts) == {1, 6}
    for flip in [0, *(1 << b for b in range(23))]:
        row, codeword = near_codewords(x ^ flip)
        home = home_codeword(x)
        met = np.zeros(len(x), dtype=bool)
        met[row[codeword == home[row]]] = True
        assert met.all()


def flipped(fp, bits):
    for b in bits:
        fp ^= 1 << b
    return fp


def signed(fp):
    return fp - (1 << 64) if fp >> 63 else fp


@pytest.mark.parametrize("max_bits", [3, 1, 0])
def test_every_near_pair_is_found_once(spark, max_bits):
    random.seed(9)
    fps = {random.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1}
    for fp in list(fps)[:120]:
        for _ in range(4):
            fps.add(flipped(fp, random.sample(range(64), random.randint(1, 5))))
    fps = sorted(fps)
    want = sorted(
        tuple(sorted((signed(a), signed(b))))
        for k, a in enumerate(fps) for b in fps[k + 1 :] if (a ^ b).bit_count() <= max_bits
    )
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    assert sorted(map(tuple, near_fingerprints(df, max_bits).collect())) == want
    assert want or not max_bits


def test_more_bits_than_the_keys_stand_are_refused(spark):
    with pytest.raises(ValueError):
        near_fingerprints(spark.createDataFrame([(1,)], "fp long"), 4)


def plain_groups(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    found = components(range(len(rows)), links)
    ids = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[found[k]] = min(doc_id, ids.get(found[k], doc_id))
    return sorted((repr(d), f"{fps[k]:016x}", repr(ids.get(found[k]))) for k, (d, _) in enumerate(rows))


def test_groups_of_a_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    base = rows[7][1] * 6
    for k in range(30):  # near copies, some in chains
        words = base.split()
        words[k % 3 * 40] = f"w{k}"
        rows.append((10_000 + k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(repr(r["doc_id"]), r["fingerprint"], repr(r["component_id"])) for r in simhash_groups(df).collect()]
    assert sorted(got) == plain_groups(rows)
    kept = drop_near_copies(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({eval(c) for _, _, c in plain_groups(rows)})


def test_odd_rows(spark):
    docs = odd_rows(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [(repr(r["doc_id"]), r["fingerprint"], repr(r["component_id"])) for r in simhash_groups(docs).collect()]
    assert sorted(got) == plain_groups(rows)
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    groups = {f for _, f, _ in plain_groups(rows)}
    assert kept.count() == len(groups)
    # Of six texts that are equal the smallest id stays, once.
    assert [r["doc_id"] for r in kept.collect() if r["text"] and r["text"].startswith("One")] == [1]


def test_equal_rows_keep_one(spark):
    df = spark.createDataFrame([(5, "same text of five words")] * 3 + [(None, "another text with other words")] * 2, "doc_id long, text string")
    assert sorted(map(repr, (r["doc_id"] for r in drop_near_copies(df).collect()))) == ["5", "None"]


def test_empty_table(spark):
    assert simhash_groups(no_rows(spark)).count() == 0
    assert drop_near_copies(no_rows(spark)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_links(spark, seed):
    random.seed(seed)
    links = [(random.randrange(400), random.randrange(400)) for _ in range(260)]
    links += [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2100)] + [(5, 5)]
    df = spark.createDataFrame([*links, (None, 3), *links[:20]], "a long, b long")
    nodes = {n for pair in links for n in pair}
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == components(nodes, links)


def test_components_without_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
