"""BPE against the public library, token counts, round trips."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_cases import no_rows, odd_rows
from ringwatch.llm.encoding import decode_ids, encode_texts, encoding_digests
from ringwatch.llm.token_counts import count_tokens, whole_token_counter
from ringwatch.llm.wordbpe import Cached, WordBpe

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = [
    "a", "the", "'s", "'LL", " ", "\t", "\n", "\x1c", "\x85", "\xa0", " ", "​", "Σ", "ΑΣ", "İ", "é", "é",
    "́", "ﬁ", "½", "٣", "中文", "😀", "👍🏽", "<|endoftext|>", "<|startoftext|>", "<|END", "!", "...", "$%", "\x00",
    "ß", "ẞ", "K", "Å", "한국", "क्षि", "1234", "_", "Ⅷ", "Don't", "WE'RE",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def bpe():
    with open(PATH, encoding="utf-8") as file:
        return WordBpe(file.read())


def strange_texts(n):
    random.seed(5)
    made = ["".join(random.choices(PIECES, k=random.randint(0, 12))) for _ in range(n)]
    return [*made, "", "a" * 3000, "!" * 3000, "ab" * 2000, " " * 500]


def test_ids_and_decoded_text_equal_the_library(bpe, library):
    whole = bpe.whole_tokens()
    count = whole_token_counter(bpe, whole)
    for text in strange_texts(4000):
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text) == ids, text
        assert count(text) == len(ids), text
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_code_point(bpe, library):
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(codes), 1 << 16):
        texts = [f"a{chr(c)}b" for c in codes[k : k + (1 << 16)]]
        for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
            assert bpe.encode(text) == found.ids, ascii(text)


def test_whole_tokens_are_one_token_each(bpe, library):
    whole = sorted(bpe.whole_tokens())
    assert len(whole) > 30_000
    for part in random.Random(1).sample(whole, 500):
        assert len(library.encode(part, add_special_tokens=False).ids) == 1


def test_cache_forgets_but_answers_the_same():
    asked = []
    cache = Cached(lambda k: asked.append(k) or k * 2, entries=3)
    keys = [*"abcdefghij", *"abcdefghij", "x" * 1000, "x" * 1000]
    assert [cache[k] for k in keys] == [2 * k for k in keys]
    assert len(cache) <= 3 and "x" * 1000 not in cache


def test_operators_on_the_table(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    counted = {r["doc_id"]: r for r in count_tokens(docs, PATH).collect()}
    digests = {r["doc_id"]: r for r in encoding_digests(docs, PATH).collect()}
    assert counted.keys() == texts.keys() == digests.keys()
    for doc_id, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert tuple(counted[doc_id]) == (doc_id, len(text.encode()), len(ids), len(ids) > 2048)
        joined = " ".join(map(str, ids)).encode()
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        assert digests[doc_id]["n_tokens"] == len(ids)
        assert digests[doc_id]["ids_sha256"] == hashlib.sha256(joined).hexdigest()
        assert digests[doc_id]["decoded_sha256"] == hashlib.sha256(decoded).hexdigest()


def test_odd_rows(spark, library):
    docs = odd_rows(spark)
    want = sorted(
        ((r["doc_id"] or -1, len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect())
    )
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in count_tokens(docs, PATH).collect()) == want
    encoded = encode_texts(docs, PATH)
    assert sorted((r["doc_id"] or -1, len(r["ids"])) for r in encoded.collect()) == want
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in encoding_digests(docs, PATH).collect()) == want
    back = {(r["doc_id"], r["text"]) for r in decode_ids(encoded.filter("doc_id = 1"), PATH).collect()}
    assert back == {(1, library.decode(library.encode("One short text, with a few words.").ids, skip_special_tokens=False))}


def test_empty_table(spark):
    for df in (count_tokens(no_rows(spark), PATH), encoding_digests(no_rows(spark), PATH)):
        assert df.count() == 0
