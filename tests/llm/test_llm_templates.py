"""The template tree against a plain one."""

import random
import re
from collections import Counter

import pytest

from llm_cases import no_rows, odd_rows
from ringwatch.llm.templates import drop_repeated_lines


def plain_drop(rows, min_docs=3, exact_docs=2, depth=3, min_tokens=4):
    """(doc_id, text) -> the same without the lines that recur, by dictionaries.

    Rows of the same id and text are one document, but each of them supports its tokens.
    """
    lines, support, leaves = [], Counter(), {}
    for doc in rows:
        for number, line in enumerate((doc[1] or "").split("\n")):
            exact = tuple(w for w in re.split("[ \t\x0b\x0c\r]+", line) if w)
            tokens = tuple(None if re.search("[0-9]", t) else t for t in exact)
            if len(tokens) >= min_tokens:
                leaf = (len(tokens), tokens[:depth])
                lines.append((doc, number, leaf, tokens, exact))
                leaves.setdefault(leaf, set()).add(exact)
                support.update((leaf, p, t) for p, t in enumerate(tokens))

    def template(leaf, tokens):
        n = len(tokens) - depth
        least = max(3, -(-60 * n // 100))
        at = {p: support[leaf, p, t] for p, t in enumerate(tokens) if p >= depth and t and support[leaf, p, t] >= min_docs}
        if len(leaves[leaf]) == 1 or len(at) < least:
            return None, 0
        usual = sorted(at.values(), reverse=True)[least - 1]
        kept = tuple((p, tokens[p]) for p in at if 2 * at[p] >= usual)
        return ((leaf, kept), usual) if len(kept) < n or None in leaf[1] else (None, 0)

    usual, groups = {}, {}
    for doc, number, leaf, tokens, exact in lines:
        name, most = template(leaf, tokens)
        usual[name] = max(usual.get(name, 0), most)
        groups.setdefault(name, []).append((doc, number))
        groups.setdefault(exact, []).append((doc, number))
    docs = {g: len({doc for doc, _ in at}) for g, at in groups.items()}
    true = {g for g, at in groups.items() if g in usual and g and 2 * len(at) >= usual[g] and docs[g] >= min_docs}
    # First is the smallest id, null last.
    first = {g: min(at, key=lambda x: (x[0][0] is None, x[0][0] or 0, x[1])) for g, at in groups.items()}
    gone = set()
    for doc, number, leaf, tokens, exact in lines:
        name = template(leaf, tokens)[0]
        group = name if name in true else exact
        if (name in true or docs[exact] >= exact_docs) and (doc, number) != first[group]:
            gone.add((doc, number))
    out = []
    for doc in rows:
        kept = [line for k, line in enumerate((doc[1] or "").split("\n")) if (doc, k) not in gone]
        out.append((doc[0], None if doc[1] is None else "\n".join(kept)))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyz"]
    rows = []
    for d in range(120):
        lines = [" ".join(rng.choices(words, k=rng.randint(1, 12))) for _ in range(rng.randint(0, 5))]
        if rng.random() < 0.4:
            lines.append("all rights reserved by the " + rng.choice(words) + " company since " + str(rng.randint(1900, 2020)))
        if rng.random() < 0.3:
            lines.insert(0, f"user {rng.choice(words)} logged in from host {rng.choice(['p', 'q'])} at port {rng.randint(1, 9)}")
        if rng.random() < 0.1:
            lines += lines[-1:]
        rows.append((d, "\n".join(lines)))
    return rows + rows[:3]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bits", [24, 6])
def test_same_as_plain_tree(spark, seed, bits):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = drop_repeated_lines(df, counts=True, bits=bits).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == plain_drop(rows)
    assert sum(r["n_dropped"] for r in got) > 25
    for r in got:
        assert r["n_lines"] - r["n_dropped"] == (len(r["text"].split("\n")) if r["text"] or r["n_lines"] > r["n_dropped"] else 0)


def test_long_passage_that_repeats(spark):
    rng = random.Random(3)
    passage = " ".join("".join(rng.choices("abcdef", k=5)) for _ in range(60))
    rows = [(k, f"own line of doc number {'xyzvw'[k]}{'klmno'[k]} with some more words here{'pqrst'[k]}\n{passage}") for k in range(5)]
    texts = {r["doc_id"]: r["text"] for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [passage in texts[k] for k in range(5)] == [True, False, False, False, False]


def test_odd_rows(spark):
    docs = odd_rows(spark)
    got = drop_repeated_lines(docs)
    assert got.schema == docs.schema
    want = plain_drop([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == want


def test_empty_table(spark):
    assert drop_repeated_lines(no_rows(spark), counts=True).count() == 0
