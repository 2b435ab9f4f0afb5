"""Lines and templates that recur: passages of two documents, fields at any size, clean lines that only look alike."""

import random

import pytest

from ringwatch.llm.templates import drop_repeated_lines
from test_llm_templates import corpus, plain_drop


def dropped(spark, rows):
    """doc_id -> text after the lines that recur are gone."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r["text"] for r in drop_repeated_lines(df).collect()}


def word(rng):
    return "".join(rng.choices("abcdefghij", k=6))


def test_passage_of_exactly_two_documents(spark):
    rng = random.Random(5)
    passage = " ".join(word(rng) for _ in range(60))
    own = [" ".join(word(rng) for _ in range(30)) for _ in range(12)]
    rows = [(k, f"{own[3 * k]}\n{passage if k in (1, 2) else own[3 * k + 1]}\n{own[3 * k + 2]}") for k in range(4)]
    texts = dropped(spark, rows)
    assert [passage in texts[k] for k in range(4)] == [False, True, False, False]
    assert [texts[k].count("\n") for k in range(4)] == [2, 2, 1, 2]


@pytest.mark.parametrize("n", [500, 50_000])
def test_template_of_two_fields_at_any_size(spark, n):
    rng = random.Random(n)
    values = [word(rng) for _ in range(500)]
    rows = [(k, f"please contact our {rng.choice(values)} office in {rng.choice(values)} today") for k in range(n)]
    texts = dropped(spark, rows)
    assert [k for k in range(n) if texts[k]] == [0]


def test_clean_lines_that_look_alike_stay(spark):
    rng = random.Random(8)
    rows = []
    for k in range(60):
        lines = [" ".join(str(rng.randint(0, 10**9)) for _ in range(n)) for n in (4, 6, 9)]
        lines += [f"row {k} has {rng.randint(0, 10**9)} of {rng.randint(0, 10**9)} parts"]
        lines += [f"it was the {word(rng)}", f"it was the {word(rng)} of", f"so are for {word(rng)} {word(rng)}"]
        rows.append((k, "\n".join(lines)))
    assert dropped(spark, rows) == dict(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_as_plain_rule(spark, seed):
    rows = corpus(seed)[:120]
    want = plain_drop(rows)
    assert want != sorted(rows, key=repr)
    assert sorted(dropped(spark, rows).items(), key=repr) == want
