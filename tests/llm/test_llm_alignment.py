"""Alignment of two tokenizers against a plain walk over the libraries' tokens."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm_cases import no_rows, odd_rows
from ringwatch.llm.alignment import TokenizerPair, align_tokenizers, word_pieces

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORDS = ["the", "Straße", "été", "don't", "we'LL", "1234", "foo_bar", "<|endoftext|>", "<s>", "<0x41>", "中文", "😀", "نص", "x" * 40]
SPACES = [" ", " ", " ", " ", "  ", "\n", " \n", "\n ", "\t", "\xa0", " 　x", "\x1c"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_FILE)


@pytest.fixture(scope="module")
def pair():
    with open(A_FILE, encoding="utf-8") as spec, open(B_FILE, "rb") as model:
        return TokenizerPair(spec.read(), model.read())


def plain_tokens(text, libraries, pair):
    """(ids, bytes) of both sides, or nothing."""
    if not text:
        return [], []
    a, b = libraries
    left = [(i, pair.a_bytes[i].as_py()) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, pair.b_bytes[i].as_py()) for i in b.encode(text)]
    whole = (" " + text).encode()
    if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
        return [], []
    return left, right


def ranges(tokens):
    out, at = [], 0
    for _, data in tokens:
        out.append((at, at + len(data)))
        at += len(data)
    return out


def plain_alignment(rows, libraries, pair):
    made, counts = [], Counter()
    for doc, text in rows:
        left, right = plain_tokens(text, libraries, pair)
        ra, rb = ranges(left), ranges(right)
        links, j = [], 0
        for i, (start, stop) in enumerate(ra):
            while rb[j][1] <= start:
                j += 1
            k = j
            while k < len(rb) and rb[k][0] < stop:
                links.append((left[i][0], right[k][0]))
                k += 1
        counts.update(links)
        groups, waiting, i, j = [], ([], []), 0, 0
        while i < len(left) or j < len(right):
            # The side that is behind goes on.
            if (ra[i - 1][1] if i else 0) <= (rb[j - 1][1] if j else 0):
                waiting[0].append(str(left[i][0]))
                i += 1
            else:
                waiting[1].append(str(right[j][0]))
                j += 1
            if i and j and ra[i - 1][1] == rb[j - 1][1]:
                groups.append(",".join(waiting[0]) + "|" + ",".join(waiting[1]))
                waiting = ([], [])
        made.append((doc, left, right, links, groups))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for doc, left, right, links, groups in made:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        n_best = sum(counts[x] == best[x[1]] for x in links)
        out.append((doc, len(left), len(right), len(groups), len(links), n_best, sum(counts[x] for x in links), digest))
    return sorted(out, key=repr)


def alignment(docs, **options):
    return sorted(map(tuple, align_tokenizers(docs, A_FILE, B_FILE, **options).collect()), key=repr)


def strange_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(SPACES) * (k > 0) + rng.choice(WORDS) for k in range(rng.randint(0, 9))) for _ in range(n)]


def test_words_alone_have_the_same_tokens(libraries, pair):
    a, b = libraries
    texts = [t for t in strange_texts(3000) if t] + ["".join(map(chr, range(0x250))), " ", "a ", " a", "a  b"]
    cut = 0
    for text in texts:
        pieces = word_pieces(text)
        cut += len(pieces) > 1
        column = pa.array(pieces)
        ids = pair.a_ids(column, lambda _: len(pieces) > 1)  # noqa: B023
        assert sum(ids.to_pylist(), []) == a.encode(" " + text, add_special_tokens=False).ids, text
        assert sum(pair.b_ids(column).to_pylist(), []) == b.encode(text), text
    assert cut > 300
    for code in range(0x20, 0x250):
        piece = f"a{chr(code)}b{chr(code)}{chr(code)}1{chr(code)}"
        assert pair.a_ids(pa.array([piece]), lambda p: p.strip() == p).to_pylist() == [a.encode(" " + piece, add_special_tokens=False).ids]


def test_no_piece_goes_on_over_a_space(pair):
    for side in (pair.a_bytes, pair.b_bytes):
        assert not any(" " in x.as_py().decode(errors="replace").strip() for x in side)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 100}, {"hot_pairs": 10}, {"hot_pairs": 0, "block_bytes": 60}])
def test_same_as_plain_walk(spark, libraries, pair, options):
    texts = strange_texts(120) + ["a▁b", "plain words only here", "plain words only here"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (None, "plain words"), (None, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain_alignment(rows, libraries, pair)
    assert alignment(df, **options) == want
    assert sum(r[5] for r in want) < sum(r[4] for r in want)


def test_given_documents(spark, folder, libraries, pair):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert alignment(docs) == plain_alignment(rows, libraries, pair)


def test_odd_rows(spark, libraries, pair):
    docs = odd_rows(spark)
    want = plain_alignment([(r["doc_id"], r["text"]) for r in docs.collect()], libraries, pair)
    assert alignment(docs) == want


def test_empty_table(spark):
    assert alignment(no_rows(spark)) == []
