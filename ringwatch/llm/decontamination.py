"""Benchmark decontamination with an FM-index per shard of documents.

Documents are indexed once, in shards of about a million words that never cut a
document; the index is a table of its own, one row a shard. The windows of the benchmark
come in blocks of bounded size, each of which is sent to all tasks and searched backwards
in every shard. Occurrences are located by sampled suffix positions and merged to spans
of words to remove. Nothing of a document is shuffled; only with several blocks are the
spans of a document brought together by key.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.fm_index import FmIndex, FmParts, build_index
from ringwatch.llm.tasks import map_batches, quoted
from ringwatch.operators.ordered import row_numbers
from ringwatch.session import store

#: Consecutive words that make a window.
WINDOW = 10
#: Words after which a shard is closed; a longer document is a shard of its own.
SHARD_WORDS = 1 << 20
#: Pairs of a window and its item that are sent to the tasks at once.
BLOCK_ROWS = 1 << 18
#: Bytes of a row group of the index table: a few shards, so that readers hold no more.
ROW_GROUP = 16 << 20

# Letters A-Z in lower case; every byte that is in no word becomes a space.
_FOLD = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_PARTS = ["counts", "levels", "marks", "samples"]


def folded_words(text: bytes | None) -> list[bytes]:
    """The words of a text: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z."""
    return text.translate(_FOLD).split() if text else []


class _Numbers(dict):
    """Words numbered from 1 on as they come."""

    def __missing__(self, word):
        self[word] = number = len(self) + 1
        return number


def index_documents(
    docs: DataFrame, shard_words: int = SHARD_WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The FM-indexes of ``docs``, written to the checkpoint folder: one row per shard.

    A shard's row holds its documents in order (``doc_ids``, ``digests`` of their texts,
    ``ends`` in the text of symbols), its vocabulary, and the parts of its index. Null and
    empty texts are documents without words; any ids are taken, null and repeated ones too.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        made = 0
        numbers, texts, ids, digests, size = _Numbers(), [], [], [], 0

        def shard() -> pa.RecordBatch:
            text = np.concatenate(texts)
            parts = build_index(text, len(numbers) + 1)
            blobs = [parts.counts, parts.levels, parts.marks, parts.samples, np.flatnonzero(text == 0)]
            row = [
                pa.array([task + made]),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids, id_type)),
                pa.array([digests], pa.list_(pa.binary())),
                pa.array([b" ".join(numbers)], pa.binary()),
                *[pa.array([blob.tobytes()], pa.binary()) for blob in blobs],
            ]
            return pa.RecordBatch.from_arrays(row, names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for number, cell in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                content = cell.as_py()
                words = folded_words(content)
                texts.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                texts.append(np.zeros(1, np.uint32))
                ids.append(number)
                digests.append(hashlib.md5(content or b"").digest())
                size += len(words) + 1
                if size >= shard_words:
                    yield shard()
                    made += 1
                    numbers, texts, ids, digests, size = _Numbers(), [], [], [], 0
        if ids:
            yield shard()

    kind = docs.schema[id_column].dataType.simpleString()
    blobs = ", ".join(f"{name} binary" for name in ["vocabulary", *_PARTS, "ends"])
    schema = f"shard long, doc_ids array<{kind}>, digests array<binary>, {blobs}"
    names = ["shard", "doc_ids", "digests", "vocabulary", *_PARTS, "ends"]
    slim = docs.select(F.col(quoted(id_column)), F.col(quoted(text_column)))
    return store(
        map_batches(slim, work, schema),
        "fm-index",
        **{"parquet.block.size": ROW_GROUP, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1},
    )


def benchmark_windows(
    items: DataFrame, window: int = WINDOW, id_column: str = "item_id", text_column: str = "text"
) -> DataFrame:
    """``phrase, item``: each different window of each item; a text of fewer words is one window, of none has none.

    Ids are given as strings, a null id as the empty one; rows of one id are one item.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases, found = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                words = folded_words(text.as_py())
                if words:
                    distinct = {b" ".join(words[k : k + window]) for k in range(max(1, len(words) - window + 1))}
                    phrases.extend(distinct)
                    found.extend([item] * len(distinct))
            yield pa.RecordBatch.from_arrays(
                [pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(found, pa.string())], ["phrase", "item"]
            )

    slim = items.select(F.coalesce(F.col(quoted(id_column)).cast("string"), F.lit("")), F.col(quoted(text_column)))
    return map_batches(slim, work, "phrase string, item string").distinct()


class Block:
    """Windows to search for: their words by number, and the items that have them."""

    def __init__(self, rows: list[tuple[str, str]]):
        phrases = sorted({phrase for phrase, _ in rows})
        number = {phrase: k for k, phrase in enumerate(phrases)}
        self.items = sorted({item for _, item in rows})
        item_number = {item: k for k, item in enumerate(self.items)}
        pairs = sorted((number[phrase], item_number[item]) for phrase, item in rows)
        self.item_of = np.array([item for _, item in pairs], np.int64)
        self.first = np.searchsorted(np.array([p for p, _ in pairs], np.int64), np.arange(len(phrases) + 1))
        words = [phrase.encode().split(b" ") for phrase in phrases]
        self.length = np.array([len(w) for w in words], np.int64)
        self.words = sorted({w for phrase in words for w in phrase})
        place = {w: k + 1 for k, w in enumerate(self.words)}
        # Numbers of words, from 1 on, filled up with 0 at the front.
        self.matrix = np.zeros((len(words), max(map(len, words), default=1)), np.int64)
        for line, phrase in zip(self.matrix, words):
            line[len(line) - len(phrase) :] = [place[w] for w in phrase]


def _runs(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true places."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def search_shard(row: dict, block: Block) -> tuple[list[list[tuple[int, int]]], list[list[str]]]:
    """The merged spans of words and the items of each document of a shard."""
    ends = np.frombuffer(row["ends"], np.int64)
    marks = np.frombuffer(row["marks"], np.uint64)
    parts = FmParts(
        np.frombuffer(row["counts"], np.uint32),
        np.frombuffer(row["levels"], np.uint64).reshape(-1, len(marks)),
        marks,
        np.frombuffer(row["samples"], np.uint32),
    )
    index = FmIndex(parts)
    symbol = {w: k + 1 for k, w in enumerate(row["vocabulary"].split(b" "))} if row["vocabulary"] else {}
    own = np.array([0, *[symbol.get(w, -1) for w in block.words]], np.int64)
    low, high = index.search(own[block.matrix])
    counts = high - low
    phrase = np.repeat(np.arange(len(counts)), counts)
    rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
    position = index.locate(rows)
    change = np.zeros(int(ends[-1]) + 2, np.int64)
    np.add.at(change, position, 1)
    np.add.at(change, position + block.length[phrase], -1)
    starts, stops = _runs(np.cumsum(change) > 0)
    doc = np.searchsorted(ends, starts)
    base = np.concatenate([[0], ends[:-1] + 1])
    spans: list[list[tuple[int, int]]] = [[] for _ in ends]
    for k, a, b in zip(doc.tolist(), (starts - base[doc]).tolist(), (stops - base[doc]).tolist()):
        spans[k].append((a, b))
    # Pairs of document and window once, then of document and item.
    pairs = np.unique(np.searchsorted(ends, position) * len(block.length) + phrase) if len(phrase) else np.zeros(0, np.int64)
    window = pairs % max(len(block.length), 1)
    many = block.first[window + 1] - block.first[window]
    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(block.first[window], many)
    whose = np.unique(np.repeat(pairs // max(len(block.length), 1), many) * len(block.items) + block.item_of[at])
    items: list[list[str]] = [[] for _ in ends]
    for k in whose.tolist():
        items[k // len(block.items)].append(block.items[k % len(block.items)])
    return spans, items


_FOUND = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _search(index: DataFrame, block: Block) -> DataFrame:
    sent = index.sparkSession.sparkContext.broadcast(block)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                cells = batch.slice(k, 1)
                row = {name: cells.column(name)[0].as_py() for name in ["vocabulary", *_PARTS, "ends"]}
                spans, items = search_shard(row, sent.value)
                n = len(spans)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(cells.column("shard").to_numpy(), n)),
                        pa.array(np.arange(n)),
                        cells.column("doc_ids").flatten(),
                        cells.column("digests").flatten(),
                        pa.array(np.diff(np.frombuffer(row["ends"], np.int64), prepend=-1) - 1),
                        pa.array(spans, _SPAN),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names,
                )

    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["shard", "row", "doc_id", "digest", "n_words", "spans", "items"]
    return map_batches(index, work, f"shard long, row long, doc_id {kind}, digest binary, {_FOUND}")


def _together(found: list[DataFrame]) -> DataFrame:
    """One row per document from the rows of each block: spans are merged, items united."""
    if len(found) == 1:
        return found[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = []
            for spans in batch.column("spans").to_pylist():
                out: list[tuple[int, int]] = []
                for a, b in sorted((s["start"], s["end"]) for s in spans):
                    if out and a <= out[-1][1]:
                        out[-1] = (out[-1][0], max(b, out[-1][1]))
                    else:
                        out.append((a, b))
                merged.append(out)
            yield batch.set_column(batch.schema.get_field_index("spans"), "spans", pa.array(merged, _SPAN))

    rows = (
        reduce(DataFrame.unionByName, found)
        .groupBy("shard", "row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("digest").alias("digest"),
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
    )
    return map_batches(rows, work, rows.schema)


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_rows: int = BLOCK_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, n_words, spans, items.

    ``spans`` are the runs [start, end) of words that lie in an occurrence of a window,
    merged where they overlap or touch; ``items`` the ids, as strings, of the items whose windows
    occur. ``digest`` is the MD5 of the text, which with the id finds the row again. A
    window is ``window`` consecutive words of an item, or all words of a shorter one.

    Null and empty texts have no words and no spans; rows with the same id are searched
    each for itself, null ids too; items without words have no windows, a null item id
    counts as the empty one. An empty table of documents gives an empty table, without items
    nothing is found. Texts are searched whole; no task holds more than a shard and
    a block of windows. Other columns are not read.
    """
    index = index_documents(docs, shard_words, id_column, text_column)
    pairs = row_numbers(benchmark_windows(items, window, item_column, item_text_column), ["phrase", "item"])
    pairs = store(pairs.withColumn("block", F.floor((F.col("row_no") - 1) / block_rows)), "benchmark-windows")
    blocks = (pairs.agg(F.max("block")).first()[0] or 0) + 1
    # A block has at most ``block_rows`` rows, so it may come to the driver and go out to the tasks.
    found = []
    for k in range(blocks):
        rows = pairs.filter(F.col("block") == k).select("phrase", "item").collect()
        found.append(_search(index, Block([(r[0], r[1]) for r in rows])))
    return _together(found).drop("shard", "row")


def contamination_report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each row; cases as in :func:`find_contamination`.

    The digest is that of the item ids, sorted as strings, with commas between them (of the
    empty text where there are none).
    """
    found = find_contamination(docs, items, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the words of the spans and what stands between them."""
    data = text.encode()
    words = [m.span() for m in _WORD.finditer(data)]
    out, at = [], 0
    for start, end in spans:
        out.append(data[at : words[start][0]])
        at = words[end - 1][1]
    return b"".join([*out, data[at:]]).decode()


def remove_contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` with the found spans cut out of their texts; rows, their number and all columns stay.

    Rows are joined with their spans by id and digest of the text, so that equal rows share
    one entry. Only documents with spans take part in the join.
    """
    id_column, text_column = options.get("id_column", "doc_id"), options.get("text_column", "text")
    found = find_contamination(docs, items, **options).filter(F.size("spans") > 0)
    slim = found.select(
        F.struct(F.col("doc_id").alias("id"), F.lower(F.hex("digest")).alias("digest")).alias("__key"),
        F.col("spans").alias("__spans"),
    ).dropDuplicates(["__key"])
    digest = F.md5(F.coalesce(F.col(quoted(text_column)), F.lit("")).cast("binary"))
    key = F.struct(F.col(quoted(id_column)).alias("id"), digest.alias("digest"))
    marked = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("__row"), key.alias("__own"))
    joined = marked.join(slim, F.col("__own").eqNullSafe(F.col("__key")), "left").select("__row.*", "__spans")
    at = docs.columns.index(text_column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(batch.num_columns - 1).to_pylist()
            texts = [
                cut_spans(t.as_py(), [(s["start"], s["end"]) for s in found]) if found else t.as_py()
                for t, found in zip(batch.column(at), spans)
            ]
            kept = batch.select(range(batch.num_columns - 1))
            yield kept.set_column(at, kept.schema.field(at), pa.array(texts, kept.schema.field(at).type))

    return map_batches(joined, work, docs.schema)
