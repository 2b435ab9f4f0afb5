"""Alignment of two tokenizers' tokens over the same text, as an Arrow pipeline.

A block of documents becomes two flat columns of tokens with parent indices. Cumulative
sums of token bytes, taken anew for each document, give every token's end; an Acero join
of both sides on (document, end) finds the common ends, which cut the tokens into groups,
and, sorted and filled, the pairs of tokens that overlap. Partial counts of id pairs are
grouped in the task and added up by Spark.

Neither side has a token that goes on over a space into the next word, so texts are tokenized
by words (:func:`word_pieces` says which texts that holds for), each different word of a block once.
Texts are read once; each document's links are stored as numbers, from which pairs are counted and,
with the counts of the whole corpus, documents summed up.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.llm.tasks import map_batches, quoted
from ringwatch.llm.wordbpe import byte_letters
from ringwatch.session import store

#: Bytes of text that are aligned at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
#: Id pairs whose counts go out to the tasks; the others are joined by a shuffle.
HOT_PAIRS = 1 << 20
# Pairs that a task gathers before it passes them on.
_WAITING_PAIRS = 1 << 20

# Fixed value: the pattern by which byte-level vocabularies cut texts to words.
_BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Texts with spaces beside other white space, at either end, or with the sign that stands for a space, are one piece.
_NOT_BY_WORDS = re.compile("\\s |  | \\s|^\\s|\\s$|▁")
# Letters whose classes no version of Unicode has changed.
_SETTLED = re.compile("[\x00-ɏ]*")
_USUAL_LENGTH = 1000


def _settled(piece: str) -> bool:
    """Whether a piece has settled letters only, and the usual length."""
    return len(piece) <= _USUAL_LENGTH and (piece.isascii() or _SETTLED.fullmatch(piece) is not None)


class TokenizerPair:
    """Both tokenizers: A from a byte-level BPE file, B from a sentencepiece model."""

    def __init__(self, spec: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(spec)
        self._library.encode_special_tokens = True
        content = json.loads(spec)
        vocab: dict[str, int] = content["model"]["vocab"]
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        a_bytes = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items() if s not in special}
        a_bytes |= {i: s.encode() for s, i in special.items()}
        self.a_bytes = pa.array([a_bytes.get(i, b"") for i in range(max(a_bytes) + 1)], pa.binary())
        self._fast = None
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in content["model"]["merges"]]
        rules = content["pre_tokenizer"]
        if made == sorted(made) and rules["type"] == "ByteLevel" and rules["use_regex"] and not content["normalizer"]:
            # Merges are in the order of the ids they make, so that ranks of byte strings say the same.
            ranks = {b: i for i, b in a_bytes.items() if i not in special.values()}
            self._fast = tiktoken.Encoding("a", pat_str=_BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_proto=model)

        def b_piece(i: int) -> bytes:
            piece = self._b.id_to_piece(i)
            return bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace("▁", " ").encode()

        self.b_bytes = pa.array([b_piece(i) for i in range(self._b.get_piece_size())], pa.binary())
        self.a_length = pc.binary_length(self.a_bytes).cast(pa.int64())
        self.b_length = pc.binary_length(self.b_bytes).cast(pa.int64())
        # Ids as text with what may follow them: three kinds, one after the other.
        self.a_text = pa.array([f"{i}{s}" for s in ",|" for i in range(len(self.a_bytes))])
        self.b_text = pa.array([f"{i}{s}" for s in ",;" for i in range(len(self.b_bytes))])
        self.a_size, self.b_size = len(self.a_bytes), len(self.b_bytes)
        # Numbers of id pairs: as many bytes as both vocabularies need.
        self.number = np.uint32 if self.a_size * self.b_size < 1 << 32 else np.uint64

    def a_ids(self, pieces: pa.StringArray, by_words: Callable[[str], bool]) -> pa.ListArray:
        """A's ids of a space and each of the pieces.

        Pieces that may be followed by others may as well be tokenized in one text, which is
        then cut again where their bytes end.
        """
        texts = pieces.to_pylist()
        fast = self._fast is not None
        plain = [k for k, p in enumerate(texts) if fast and _settled(p) and by_words(p)]
        ids = np.array(self._fast.encode_ordinary(" " + " ".join([texts[k] for k in plain])) if plain else [], np.int32)
        ends = np.cumsum(pc.binary_length(pieces).to_numpy()[plain].astype(np.int64) + 1)
        upto = np.searchsorted(np.cumsum(self.a_length.to_numpy()[ids]), ends, "right")
        if len(plain) == len(pieces):
            return pa.ListArray.from_arrays(pa.array(np.append(0, upto).astype(np.int32)), pa.array(ids))
        lists: list = [None] * len(pieces)
        for k, start, stop in zip(plain, [0, *upto], upto):
            lists[k] = ids[start:stop]
        others = [k for k, found in enumerate(lists) if found is None]
        encoded = self._library.encode_batch([" " + texts[k] for k in others], add_special_tokens=False)
        for k, found in zip(others, encoded):
            lists[k] = found.ids
        return pa.array(lists, pa.list_(pa.int32()))

    def b_ids(self, pieces: pa.StringArray) -> pa.ListArray:
        """B's ids of each of the pieces, in front of which it puts a space itself."""
        return pa.array(self._b.encode(pieces.to_pylist(), num_threads=1), pa.list_(pa.int32()))


@lru_cache(maxsize=1)
def _pair_of(spec: str, model: bytes) -> TokenizerPair:
    return TokenizerPair(spec, model)


def word_pieces(text: str) -> list[str]:
    """The pieces of a text that both sides tokenize each for itself.

    A space between two signs that are no white space starts a token on both sides whatever
    is around it, so there the text is cut. Other texts are one piece.
    """
    return [text] if _NOT_BY_WORDS.search(text) else text.split(" ")


def _joined_bytes(ids: pa.ListArray, table: pa.BinaryArray) -> pa.BinaryArray:
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, table.take(ids.values)), b"")


@dataclass
class Pieces:
    """The different pieces of a block with their tokens, and which of them each document has."""

    a: pa.ListArray
    b: pa.ListArray
    same: pa.BooleanArray  # whether both sides have exactly the bytes of the piece
    which: pa.Int32Array  # number of each piece of the block
    doc: np.ndarray  # its document


def block_pieces(texts: list[str], pair: TokenizerPair) -> Pieces:
    cut = [word_pieces(t) for t in texts]
    lists = pa.array(cut, pa.list_(pa.string()))
    coded = pc.list_flatten(lists).dictionary_encode()
    # A text of one piece may be one that words do not cut; all others are words of theirs.
    whole = {pieces[0] for pieces in cut if len(pieces) == 1}
    a = pair.a_ids(coded.dictionary, lambda piece: piece not in whole)
    b = pair.b_ids(coded.dictionary)
    bytes_ = pc.binary_join_element_wise(b" ", coded.dictionary.cast(pa.binary()), b"")
    same = pc.and_(
        pc.equal(_joined_bytes(a, pair.a_bytes), bytes_), pc.equal(_joined_bytes(b, pair.b_bytes), bytes_)
    )
    return Pieces(a, b, same, coded.indices, pc.list_parent_indices(lists).to_numpy())


@dataclass
class Aligned:
    """Tokens of both sides in order, common ends, and overlapping pairs; ``doc`` numbers run upwards."""

    a: pa.Array
    a_doc: np.ndarray
    b: pa.Array
    b_doc: np.ndarray
    link_doc: np.ndarray
    link_a: np.ndarray  # the ids of each pair
    link_b: np.ndarray
    group_doc: np.ndarray
    group_a: np.ndarray  # the last token of A and of B in each group
    group_b: np.ndarray


def _ends(ids: pa.Array, length: pa.Array, doc: np.ndarray) -> np.ndarray:
    """The end of each token in its document: cumulative sums that start anew with each document."""
    sizes = length.take(ids)
    total = pc.cumulative_sum(sizes).to_numpy()
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    before = np.zeros(int(doc[-1]) + 1 if len(doc) else 0, dtype=np.int64)
    before[doc[first]] = total[first] - sizes.to_numpy()[first]
    return total - before[doc]


def align_tokens(a_lists: pa.ListArray, b_lists: pa.ListArray, doc: np.ndarray, pair: TokenizerPair) -> Aligned:
    """Align lists of tokens, each of them a part of the document with the number beside it.

    Both sides of a document must have the same bytes in all, of one at least.
    """
    sides = []
    for lists, length in ((a_lists, pair.a_length), (b_lists, pair.b_length)):
        ids = pc.list_flatten(lists)
        whose = doc[pc.list_parent_indices(lists).to_numpy()]
        sides.append((ids, whose, _ends(ids, length, whose)))
    (a, a_doc, a_end), (b, b_doc, b_end) = sides
    # Document and end in one number; numbers without wide gaps spread well over hash tables.
    stride = int(a_end.max(initial=0)) + 1
    left = pa.table({"at": a_doc * stride + a_end, "a_no": np.arange(len(a))})
    right = pa.table({"at": b_doc * stride + b_end, "b_no": np.arange(len(b))})
    met = left.join(right, "at", join_type="full outer", use_threads=False).combine_chunks()
    at, a_no, b_no = (met.column(name).combine_chunks() for name in ("at", "a_no", "b_no"))
    order = np.argsort(at.to_numpy())
    link_doc = at.to_numpy()[order] // stride
    a_no, b_no = a_no.take(pa.array(order)), b_no.take(pa.array(order))
    common = pc.and_(a_no.is_valid(), b_no.is_valid())
    # A stretch between ends belongs to the first token of each side that ends at or after its own end.
    a_over, b_over = pc.fill_null_backward(a_no), pc.fill_null_backward(b_no)
    last = np.flatnonzero(common.to_numpy(zero_copy_only=False))
    group_a, group_b = a_over.to_numpy()[last], b_over.to_numpy()[last]
    link_a, link_b = a.take(a_over).to_numpy(), b.take(b_over).to_numpy()
    return Aligned(a, a_doc, b, b_doc, link_doc, link_a, link_b, link_doc[last], group_a, group_b)


def group_texts(found: Aligned, n_docs: int, pair: TokenizerPair) -> list[str]:
    """Each document's groups as text: ids with commas, a bar between the sides, semicolons between groups."""

    def places(n: int, last: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a token is its side's last of a group, and the tokens of the other side before it."""
        ends = np.zeros(n, dtype=np.int64)
        ends[last] = 1
        return ends, other[np.cumsum(ends) - ends]

    a_ends, b_before = places(len(found.a), found.group_a, np.append(0, found.group_b + 1))
    b_ends, a_before = places(len(found.b), found.group_b, np.append(found.group_a + 1, len(found.a)))
    order = np.empty(len(found.a) + len(found.b), dtype=np.int64)
    code_a = found.a.to_numpy() + a_ends * len(pair.a_bytes)
    code_b = found.b.to_numpy() + b_ends * len(pair.b_bytes) + len(pair.a_text)
    order[np.arange(len(code_a)) + b_before] = code_a
    order[np.arange(len(code_b)) + a_before] = code_b
    strings = pa.concat_arrays([pair.a_text, pair.b_text]).take(pa.array(order))
    sizes = np.bincount(found.a_doc, minlength=n_docs) + np.bincount(found.b_doc, minlength=n_docs)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return [text[:-1] for text in pc.binary_join(pa.ListArray.from_arrays(offsets, strings), "").to_pylist()]


def _blocks(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each have about ``limit`` bytes at most."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        block = np.cumsum(sizes) // limit
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        for start, stop in zip(starts, np.append(starts[1:], len(block))):
            yield batch.slice(start, stop - start)


_SIZES = ["n_a", "n_b", "n_groups", "n_links"]


def aligned_documents(docs: DataFrame, sent: Broadcast, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, text`` -> row (a number of its own), doc_id, sizes, digest, and ``links``: numbers of id pairs, in bytes.

    A pair's number is A's id times the size of B's vocabulary, and B's id.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair_of(*sent.value)
        task, row = TaskContext.get().partitionId() << 36, 0
        for batch in _blocks(batches, 1, block_bytes):
            n = batch.num_rows
            texts = batch.column(1).to_pylist()
            chosen = np.array([k for k, t in enumerate(texts) if t], dtype=np.int64)
            sizes = {name: np.zeros(n, np.int64) for name in _SIZES}
            digests, links = [""] * n, [b""] * n
            pieces = block_pieces([texts[k] for k in chosen], pair)
            same = pieces.same.take(pieces.which).to_numpy(zero_copy_only=False)
            # A document with one odd piece has no tokens. Those that are left are numbered without gaps.
            odd = np.bincount(pieces.doc, ~same, len(chosen)) > 0
            back = chosen[~odd]
            if len(back):
                keep = ~odd[pieces.doc]
                which = pieces.which.filter(pa.array(keep))
                doc = (np.cumsum(~odd) - 1)[pieces.doc[keep]]
                found = align_tokens(pieces.a.take(which), pieces.b.take(which), doc, pair)
                for name, whose in zip(_SIZES, (found.a_doc, found.b_doc, found.group_doc, found.link_doc)):
                    sizes[name][back] = np.bincount(whose, minlength=len(back))
                numbers = found.link_a.astype(pair.number) * pair.number(pair.b_size) + found.link_b.astype(pair.number)
                cuts = np.searchsorted(found.link_doc, np.arange(len(back) + 1))
                for k, text, start, stop in zip(back, group_texts(found, len(back), pair), cuts, cuts[1:]):
                    digests[k] = hashlib.sha256(text.encode()).hexdigest()
                    links[k] = numbers[start:stop].tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + n) + task),
                    batch.column(0),
                    *[pa.array(sizes[name]) for name in _SIZES],
                    pa.array(digests),
                    pa.array(links, pa.binary()),
                ],
                names,
            )
            row += n

    names = ["row", "doc_id", *_SIZES, "groups_sha256", "links"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    sizes = ", ".join(f"{name} long" for name in _SIZES)
    schema = f"row long, doc_id {kind}, {sizes}, groups_sha256 string, links binary"
    return store(map_batches(docs, work, schema), "alignment", compression="zstd")


def pair_counts(links: DataFrame, number: type) -> DataFrame:
    """``pair, n``: how many links hold each id pair linked; ``links`` has the stored links in its one column."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []

        def together() -> pa.Table:
            grouped = pa.concat_tables(waiting).group_by("pair", use_threads=False).aggregate([("n", "sum")])
            return grouped.rename_columns(["pair", "n"])

        for batch in _blocks(batches, 0, BLOCK_BYTES):
            numbers = np.frombuffer(b"".join(batch.column(0).to_pylist()), number).astype(np.int64)
            block = pa.table({"pair": numbers}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
            waiting.append(block.rename_columns(["pair", "n"]))
            if sum(map(len, waiting)) > _WAITING_PAIRS:
                waiting = [together()]
                if len(waiting[0]) > _WAITING_PAIRS // 2:
                    yield from waiting.pop().to_batches()
        if waiting:
            yield from together().to_batches()

    parts = map_batches(links, work, "pair long, n long")
    return store(parts.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")


def _hot_pairs(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent pairs, at most ``most``: all from some power of two on."""
    power = F.floor(F.log2("n"))
    by_size = counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("pairs"))
    least, room = 64, most
    for row in sorted(by_size.collect(), key=lambda r: -r["power"]):  # 64 rows at most
        room -= row["pairs"]
        if room < 0:
            break
        least = row["power"]
    return counts.filter(power >= least)


def _hot_sums(found: DataFrame, hot: Broadcast, number: type) -> DataFrame:
    """Stored documents -> the same with n_best and count_sum over hot pairs, and the links of other pairs as ``rest``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = hot.value
        for batch in _blocks(batches, at, BLOCK_BYTES):
            blobs = batch.column(at).to_pylist()
            sizes = np.array([len(b) for b in blobs], dtype=np.int64) // np.dtype(number).itemsize
            coded = pa.array(np.frombuffer(b"".join(blobs), number).astype(np.int64)).dictionary_encode()
            different, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
            place = np.searchsorted(pairs, different)
            known = pairs[place] == different
            count = np.where(known, counts[place], 0)[which]
            highest = np.where(known, best[place], False)[which]
            starts = np.concatenate([[0], np.cumsum(sizes)])

            def summed(values: np.ndarray) -> pa.Array:
                upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
                return pa.array(upto[starts[1:]] - upto[starts[:-1]])

            cold = np.flatnonzero(~known[which])
            offsets = pa.array(np.searchsorted(cold, starts).astype(np.int32))
            rest = pa.ListArray.from_arrays(offsets, pa.array(different[which[cold]]))
            arrays = [batch.column(k) for k in range(batch.num_columns) if k != at]
            yield pa.RecordBatch.from_arrays([*arrays, summed(highest), summed(count), rest], names)

    at = found.columns.index("links")
    others = found.drop("links")
    names = [*others.columns, "n_best", "count_sum", "rest"]
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others.schema)
    return map_batches(found, work, f"{kept}, n_best long, count_sum long, rest array<long>")


def _sent(spark: SparkSession, a_file: str, b_file: str) -> Broadcast:
    """Read both vocabulary files on the driver and send their content to the executors."""
    with open(a_file, encoding="utf-8") as file, open(b_file, "rb") as model:
        return spark.sparkContext.broadcast((file.read(), model.read()))


def align_tokenizers(
    docs: DataFrame,
    a_file: str,
    b_file: str,
    hot_pairs: int = HOT_PAIRS,
    block_bytes: int = BLOCK_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A text is tokenized by A with a space in front, and by B, which adds one. Places where
    tokens of both sides end cut them into groups; a link is a token of A and one of B that
    share bytes. A pair's count is the number of links, over all documents, that link these
    two ids. ``n_best`` counts the links whose count is the highest of their B id, ``count_sum``
    adds up all counts; the digest is that of :func:`group_texts`.

    A null or empty text, and one whose tokens' bytes are not those of the text (as with
    U+2581, which B takes for a space), has no tokens: zeros and an empty digest. Null and
    repeated ids are kept as they are, each row for itself; an empty table gives an empty
    table. Counts of the ``hot_pairs`` most frequent pairs go out to the tasks, links of other
    pairs are joined with their counts by a shuffle. A task holds one block of texts; a
    longer text is one block.
    """
    spark = docs.sparkSession
    sent = _sent(spark, a_file, b_file)
    pair = _pair_of(*sent.value)
    slim = docs.select(F.col(quoted(id_column)).alias("doc_id"), F.col(quoted(text_column)).alias("text"))
    found = aligned_documents(slim, sent, block_bytes)
    counts = pair_counts(found.select("links"), pair.number)
    # One row per id of B, so that it may be broadcast.
    b_id = F.col("pair") % pair.b_size
    most = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    marked = counts.join(F.broadcast(most), b_id == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    marked = store(marked, "pair-marks")
    rows = _hot_pairs(marked, hot_pairs).toArrow().sort_by("pair")
    # A last entry that no pair equals, so that every search finds a place.
    ends = {"pair": np.iinfo(np.int64).max, "n": 0, "best": False}
    hot = spark.sparkContext.broadcast([np.append(rows.column(c).to_numpy(), end) for c, end in ends.items()])
    summed = store(_hot_sums(found, hot, pair.number), "alignment-sums")
    result = ["doc_id", *_SIZES, "n_best", "count_sum", "groups_sha256"]
    if marked.count() == len(rows):
        return summed.select(*result)
    cold = summed.select("row", F.explode("rest").alias("pair")).groupBy("row", "pair").agg(F.count(F.lit(1)).alias("times"))
    more = (
        cold.join(marked, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_sum"),
        )
    )
    added = {
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
    }
    return summed.join(more, "row", "left").withColumns(added).select(*result)
