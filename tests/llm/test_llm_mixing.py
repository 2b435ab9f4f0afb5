"""Mixing against a plain computation, and its edge cases."""

import hashlib
import random
import re

import pytest

from llm_cases import no_rows, odd_rows
from ringwatch.llm.mixing import mix, mixed_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    """Cut the targets that are too high, share out again, until none is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    words, cut = sum(sizes.values()), set()
    while True:
        left = words - sum(cap * sizes[s] for s in cut)
        total = sum(weight[s] for s in order if s not in cut)
        target = {s: cap * sizes[s] if s in cut else weight[s] * left / total for s in order}
        above = {s for s in order if s not in cut and target[s] > cap * sizes[s]}
        if not above:
            return target
        cut |= above


def plain_hash(doc_id, text):
    parts = [hashlib.md5(("" if v is None else str(v)).encode()).hexdigest() for v in (doc_id, text)]
    return hashlib.md5(f"mix:{''.join(parts)}".encode()).hexdigest()[:12]


def plain_mix(rows):
    """(doc_id, source, text) -> doc_id -> size, source size, target, taken."""
    place = {d: plain_hash(d, t) for d, _, t in rows}
    size = {d: len(WORD.findall(t or "")) for d, _, t in rows}
    source = {d: s for d, s, _ in rows}
    sizes = {}
    for d, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + size[d]
    targets, out = plain_targets(sizes), {}
    for s, total in sizes.items():
        rounds = min(int(targets[s] // total), 3) if total else 0
        rest = targets[s] - rounds * total
        before, extra, open_ = 0, set(), rest > 0
        for d in sorted((d for d in size if source[d] == s), key=place.get):
            if open_ and (before + size[d] <= rest or 2 * (rest - before) > size[d]):
                extra.add(d)
            open_ = open_ and before + size[d] <= rest
            before += size[d]
        for d in (d for d in size if source[d] == s):
            out[d] = (size[d], total, targets[s], size[d] * (rounds + (d in extra)))
    return out


def corpus(seed, n=400):
    random.seed(seed)
    sources = ["b", "a", "é", None, "z", "tiny", "B"]
    rows = []
    for d in range(n):
        source = random.choices(sources, weights=[60, 10, 8, 8, 8, 1, 5])[0]
        rows.append((d, source, " ".join(["w"] * random.choice([0, 1, 5, 20, 200]))))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_plain_mix(spark, seed):
    rows = corpus(seed)
    found = mix(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    got = {r["doc_id"]: (r["mix"]["size"], r["mix"]["source_size"], r["mix"]["target"], r["mix"]["taken"]) for r in found.collect()}
    want = plain_mix(rows)
    assert got.keys() == want.keys()
    for d in want:
        assert got[d] == pytest.approx(want[d]), d
    # Near the target, within one document; never more than three times.
    for s in {s for _, s, _ in rows}:
        mine = [got[d] for d, t, _ in rows if t == s]
        assert abs(sum(m[3] for m in mine) - mine[0][2]) <= 200
    assert all(m[3] <= 3 * m[0] for m in got.values())


def test_reruns_agree_however_rows_lie(spark):
    rows = corpus(3)
    one = mixed_rows(spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(7))
    two = mixed_rows(spark.createDataFrame(rows[::-1], "doc_id long, source string, text string").coalesce(1))
    assert one.columns == ["doc_id", "source", "text"]
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))


def test_rows_without_id_do_not_share_their_fate(spark):
    rows = [(None if k < 150 else k, f"s{k % 2}", f"{'w ' * 20}t{k}") for k in range(300)]
    found = mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    for source in ("s0", "s1"):
        mine = [r["mix"] for r in found if r["source"] == source]
        assert abs(sum(m["taken"] for m in mine) - mine[0]["target"]) <= 21


def test_no_python_in_the_plan(spark):
    df = mix(spark.createDataFrame(corpus(1), "doc_id long, source string, text string"))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_odd_rows(spark):
    docs = odd_rows(spark)
    mixed = mix(docs)
    assert set(mixed.columns) == set(docs.columns)  # a column of the name is replaced, others stay
    rows = mixed.collect()
    assert len(rows) == docs.count()
    assert all(r["mix"]["size"] == len(WORD.findall(r["text"] or "")) for r in rows)
    again = [r["mix"] for r in rows if r["doc_id"] == 6]
    assert again[0] == again[1]
    assert mixed_rows(docs).columns == docs.columns


def test_without_words(spark):
    docs = spark.createDataFrame([(1, "a", ""), (2, None, None)], "doc_id long, source string, text string")
    assert {tuple(r["mix"]) for r in mix(docs).collect()} == {(0, 0, 0.0, 0, 0)}
    assert mix(no_rows(spark)).count() == 0
    assert mixed_rows(no_rows(spark)).count() == 0
