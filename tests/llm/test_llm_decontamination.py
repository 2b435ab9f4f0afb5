"""FM-index search and decontamination against plain scans."""

import hashlib
import random
import re

import numpy as np
import pytest

from llm_cases import no_rows, odd_rows
from ringwatch.llm.decontamination import benchmark_windows, contamination_report, find_contamination, remove_contamination
from ringwatch.llm.fm_index import FmIndex, build_index, suffix_order

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_report(docs, items, window=10):
    """(doc_id, text), (item_id, text) -> the report's rows by comparing every place with every window."""
    windows = {}
    for item, text in items:
        words = plain_words(text)
        for k in range(max(1, len(words) - window + 1) if words else 0):
            windows.setdefault(tuple(words[k : k + window]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words = plain_words(text)
        hit, found = set(), set()
        for k in range(len(words)):
            for n in lengths:
                at = windows.get(tuple(words[k : k + n])) if k + n <= len(words) else None
                if at:
                    hit |= set(range(k, k + n))
                    found |= at
        listed = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), listed, bool(hit)))
    return sorted(out, key=repr)


def report(docs, items, **options):
    return sorted((tuple(r) for r in contamination_report(docs, items, **options).collect()), key=repr)


def case(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Ab", "c", "dé", "E9", "f", "中", "g"])
    items = [(k, " ".join(word() for _ in range(rng.choice([0, 1, 3, 6, 9])))) for k in range(12)]
    items += [(None, "zz top"), (None, "c f c f"), (3, "again c c c"), (77, None)]
    docs = []
    for k in range(60):
        parts = [word() for _ in range(rng.randint(0, 40))]
        if k % 5 == 0:
            parts[1:1] = [rng.choice(items)[1] or ""]
        docs.append((k, rng.choice([" ", "-", "\n", ", "]).join(parts)))
    return docs + docs[:4] + [(None, "c f c f c"), (5, "zz TOP"), (5, None)], items


@pytest.mark.parametrize("seed", range(3))
def test_index_equals_a_plain_search(seed):
    rng = np.random.default_rng(seed)
    for trial in range(20):
        symbols = int(rng.integers(2, 9))
        text = np.append(rng.integers(trial % 2, symbols, int(rng.integers(1, 200))), 0)
        text = np.concatenate([text] * (1 + trial % 3))
        index = FmIndex(build_index(text, symbols))
        for _ in range(20):
            phrase = list(rng.integers(1, symbols, int(rng.integers(1, 6))))
            low, high = index.search(np.array([[0] * (5 - len(phrase)) + phrase]))
            want = [k for k in range(len(text)) if list(text[k : k + len(phrase)]) == phrase]
            assert sorted(index.locate(np.arange(low[0], high[0]))) == want
        low, high = index.search(np.array([[0, 1, -1]]))
        assert low[0] == high[0]


def test_suffixes_are_fully_sorted():
    text = np.array([1, 2, 1, 2, 1, 2, 0, 1, 2, 1, 2, 0, 1, 2, 1, 2, 0])
    ends = {p: k for k, p in enumerate(np.flatnonzero(text == 0))}

    def suffix(k):
        stop = next(p for p in sorted(ends) if p >= k)
        return [(1, int(x)) for x in text[k:stop]] + [(0, ends[stop])]

    assert list(suffix_order(text)) == sorted(range(len(text)), key=suffix)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("options", [{}, {"shard_words": 60}, {"shard_words": 100, "block_rows": 7}])
@pytest.mark.parametrize("window", [10, 4])
def test_same_as_plain_scan(spark, seed, options, window):
    docs, items = case(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain_report(docs, items, window)
    assert report(df, bench, window=window, **options) == want
    assert 0 < sum(r[-1] for r in want)


def test_spans_and_texts_without_them(spark):
    passage = "The quick brown fox jumps over the lazy dog, again and again and again!"
    docs = [
        (1, f"Before it. {passage} After it."),
        (1, f"Before it. {passage} After it."),
        (2, "Nothing of the kind is here, though the quick brown fox jumps."),
        (None, passage),
        (3, None),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("text", "doc_id", "'z' as spans", "1 as __row")
    bench = spark.createDataFrame([("q", passage)], "item_id string, text string")
    found = find_contamination(df, bench).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], [tuple(s) for s in r["spans"]], r["items"]) for r in found) == [
        (0, 14, [(0, 14)], ["q"]),
        (1, 18, [(2, 16)], ["q"]),
        (1, 18, [(2, 16)], ["q"]),
        (2, 12, [], []),
        (3, 0, [], []),
    ]
    cut = remove_contamination(df, bench)
    assert cut.columns == df.columns
    assert sorted(((r["doc_id"] or 0, r["text"]) for r in cut.collect()), key=repr) == [
        (0, "!"),
        (1, "Before it. ! After it."),
        (1, "Before it. ! After it."),
        (2, docs[2][1]),
        (3, None),
    ]


def test_windows_are_distinct_and_short_items_whole(spark):
    items = [(1, "a b c"), (1, "A, B, C"), (2, "a b c d e a b c d"), (None, "x"), (3, "--"), (4, None)]
    found = benchmark_windows(spark.createDataFrame(items, "item_id long, text string"), 4).collect()
    assert sorted(map(tuple, found)) == sorted(
        [("a b c", "1"), ("a b c d", "2"), ("b c d e", "2"), ("c d e a", "2"), ("d e a b", "2"), ("e a b c", "2"), ("x", "")]
    )


def test_odd_rows(spark):
    docs = odd_rows(spark)
    items = [(1, "alpha beta"), (2, "a few WORDS"), (3, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert report(docs, bench) == plain_report(rows, items)
    assert remove_contamination(docs, bench).count() == len(rows)


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contamination_report(no_rows(spark), bench).count() == 0
    docs = odd_rows(spark)
    assert not any(r["contaminated"] for r in contamination_report(docs, bench.limit(0)).collect())
    assert remove_contamination(docs, bench.limit(0)).count() == docs.count()
