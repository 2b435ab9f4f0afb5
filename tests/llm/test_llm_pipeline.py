"""The pipeline stage by stage against plain computations, and the registered queries."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from llm_cases import odd_rows
from ringwatch.llm.quality_rules import BUCKET_BITS, MIN_SCORE, ORDERS, PRIOR, Rules, _buckets
from ringwatch.llm.words import hashed
from test_llm_mixing import plain_mix
from test_llm_quality import plain_limit, split_ids
from test_llm_simhash import plain_groups
from test_llm_templates import plain_drop

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_quality(rows, counted, held):
    """The rows that the rules keep, by counting n-grams in one place."""
    rules = Rules(np.zeros(1 << BUCKET_BITS), ORDERS, BUCKET_BITS, MIN_SCORE)
    counts = np.zeros((2, 1 << BUCKET_BITS))
    for r in rows:
        found = np.bincount(_buckets(hashed(r["text"].encode().split(), rules._cache), ORDERS, BUCKET_BITS), minlength=1 << BUCKET_BITS)
        counts[0] += found if r["doc_id"] in counted else 0
        counts[1] += found
    expected = counts[1] * (counts[0].sum() / counts[1].sum())
    rules._ratios = np.where(counts[1] > 0, np.log((counts[0] + PRIOR) / (expected + PRIOR)), 0.0)
    judged = {r["doc_id"]: rules.judge(r["text"].encode()) for r in rows}
    limit = plain_limit([j[-3] for d, j in judged.items() if d in held and not j[-2]])
    return [r for r in rows if not judged[r["doc_id"]][-2] and judged[r["doc_id"]][-3] >= limit]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input of each stage and the result of the last, as rows."""
    folder, out = "/root/testdata/sf0.001", tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    tables = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(out / str(k)))
        docs = spark.read.parquet(str(out / str(k)))
        tables.append(docs)
    return [(t.columns, t.collect()) for t in tables]


def pairs(rows):
    return sorted(((r["doc_id"], r["text"]) for r in rows), key=repr)


def test_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "source mix", "bpe"]
    assert all(columns == COLUMNS for columns, _ in stages[:-1])


def test_quality_stage(spark, stages):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").filter("quality = 1").select("doc_id")
    assert pairs(stages[1][1]) == pairs(plain_quality(stages[0][1], *split_ids(labels)))


def test_line_stage(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1][1]]
    assert pairs(stages[2][1]) == plain_drop(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2][1])


def test_simhash_stage(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2][1]]
    firsts = {c for _, _, c in plain_groups(rows)}
    assert sorted(repr(r["doc_id"]) for r in stages[3][1]) == sorted(firsts)


def test_mix_stage(stages):
    rows = [(r["doc_id"], r["source"], r["text"]) for r in stages[3][1]]
    plain = plain_mix(rows)
    want = {d: taken // size for d, (size, _, _, taken) in plain.items() if size}
    got = {}
    for r in stages[4][1]:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert {d: n for d, n in got.items() if plain[d][0]} == {d: n for d, n in want.items() if n}


def test_bpe_stage(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in stages[4][1]:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        joined = " ".join(map(str, ids)).encode()
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        want.append((r["doc_id"], len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    assert sorted(tuple(r) for r in stages[5][1]) == sorted(want)


def test_run_gives_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert sorted(tuple(r) for r in found.collect()) == sorted(tuple(r) for r in stages[5][1])


def test_stages_take_odd_rows(spark, tmp_path):
    docs = odd_rows(spark)
    docs.limit(0).selectExpr("doc_id", "1 as quality").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.limit(0)):
            found = stage(spark, rows, str(tmp_path))
            assert name == "bpe" or found.columns == docs.columns
            assert found.count() <= 3 * rows.count()


def test_queries_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names
    assert set(entry.oracle_sql()) <= names
