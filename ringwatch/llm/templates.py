"""Line deduplication by a log-template tree.

A line is put into the tree by its number of tokens and its leading tokens, where tokens
with digits count as variable; that is a leaf. Within a leaf a token is constant if enough
lines have it at that place, as measured by the line's other tokens, else it is a variable field. What is left, constants and
fields, is the line's template. Templates that enough different documents have are
recurring, and so are other lines that two documents have word by word: the first of
their lines stays, all others are dropped.

Nothing is held per leaf: tokens are counted by (leaf, place, token), with counts added
up in each task first, so that a leaf may have a third of all lines. Only lines of leaves
that several documents reach are looked at beyond their hash. Those leaves are marked in
a bitmap of fixed size, which may mark others too; the counts settle that.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.tasks import map_batches, quoted, unused_name
from ringwatch.session import store

#: Lines of fewer tokens stay as they are.
MIN_TOKENS = 4
#: Leading tokens that lead to a leaf, after the number of tokens.
DEPTH = 3
#: Documents that make a general template recurring, and lines that a constant has at least.
MIN_DOCS = 3
#: Documents that make a line recurring that has the same tokens in all of them.
EXACT_DOCS = 2
#: Least percentage of constants in a template with variable fields, after the leading tokens, and least number.
MIN_CONSTANT_PERCENT = 60
MIN_CONSTANTS = 3
#: Least percentage of the usual support of a line that a constant has, and all constants together.
SHARE_PERCENT = 50
#: The bitmap of leaves has 2 ** BITMAP_BITS bits (two megabytes).
BITMAP_BITS = 24

_FIELD = b"<*>"
_FIELD_HASH = int(np.uint32(xxhash.xxh32_intdigest(_FIELD)).view(np.int32))
_HAS_DIGIT = re.compile(rb"[0-9]")
_VARIABLE = re.compile(rb"[^\s]*[0-9][^\s]*")


def tokens_of(line: bytes) -> list[bytes]:
    """The tokens between ASCII white space; those with digits are variable fields."""
    if _HAS_DIGIT.search(line):
        line = _VARIABLE.sub(_FIELD, line)
    return line.split()


def leaf_of(tokens: list[bytes], depth: int) -> int:
    """The leaf of a line as a signed 64-bit number."""
    return _signed(b"%d " % len(tokens) + b" ".join(tokens[:depth]))


def _signed(data: bytes) -> int:
    value = xxhash.xxh64_intdigest(data)
    return value - (1 << 64) if value >> 63 else value


def lines_of(text: bytes | None, depth: int, min_tokens: int) -> Iterator[tuple[int, int, list[bytes], bytes]]:
    """Number, leaf, tokens and text of the lines that are put into the tree."""
    for number, line in enumerate((text or b"").split(b"\n")):
        tokens = tokens_of(line)
        if len(tokens) >= min_tokens:
            yield number, leaf_of(tokens, depth), tokens, line


def recurring_leaves(docs: DataFrame, min_docs: int, depth: int, min_tokens: int) -> DataFrame:
    """``leaf``: those that lines of ``min_docs`` rows or more lead to. ``docs`` is ``text``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves: list[int] = []
            for text in batch.column(0).cast(pa.binary()):
                leaves.extend({leaf for _, leaf, _, _ in lines_of(text.as_py(), depth, min_tokens)})
            yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64())], ["leaf"])

    found = map_batches(docs, work, "leaf long")
    return found.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") >= min_docs).select("leaf")


def bitmap_of(leaves: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """One bit for each hash of ``bits`` bits that a leaf has. Its words come to the driver, 2 ** (bits - 6) at most."""
    place = F.shiftrightunsigned("leaf", 64 - bits)
    words = leaves.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(leaf, {64 - bits}) & 63 as int))")).alias("mask")
    )
    found = words.toPandas()
    bitmap = np.zeros(1 << (bits - 6), dtype=np.int64)
    bitmap[found["word"]] = found["mask"]
    return bitmap.view(np.uint8)


def candidate_lines(docs: DataFrame, bitmap: np.ndarray, depth: int, min_tokens: int, bits: int) -> DataFrame:
    """``row, doc, line_no, leaf, line, tokens`` of the lines in marked leaves.

    ``docs`` is ``row`` (a hash that stands for the row), ``doc`` (the document's id) and
    ``text``. ``line`` and ``tokens`` are hashes, of the line as it is (but for white space) and of each of its
    tokens, with fields for those that have digits.
    """
    marks = docs.sparkSession.sparkContext.broadcast(bitmap)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = marks.value
        for batch in batches:
            at, numbers, leaves, lines, hashes = [], [], [], [], []
            for k, text in enumerate(batch.column(2).cast(pa.binary())):
                for number, leaf, tokens, line in lines_of(text.as_py(), depth, min_tokens):
                    place = (leaf & 0xFFFFFFFFFFFFFFFF) >> (64 - bits)
                    if not bitmap[place >> 3] >> (place & 7) & 1:
                        continue
                    at.append(k)
                    numbers.append(number)
                    leaves.append(leaf)
                    lines.append(_signed(b" ".join(line.split())))
                    digest = xxhash.xxh32_intdigest
                    hashes.append(np.array([digest(t) for t in tokens], dtype=np.uint32).view(np.int32))
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(numbers, pa.int32()),
                    pa.array(leaves, pa.int64()),
                    pa.array(lines, pa.int64()),
                    pa.array(hashes, pa.list_(pa.int32())),
                ],
                ["row", "doc", "line_no", "leaf", "line", "tokens"],
            )

    kind = docs.schema["doc"].dataType.simpleString()
    return map_batches(
        docs, work, f"row long, doc {kind}, line_no int, leaf long, line long, tokens array<int>"
    )


def line_templates(lines: DataFrame, min_docs: int, depth: int, min_constant_percent: int) -> DataFrame:
    """``leaf, line, tokens, rows`` (each line once) -> ``leaf, line, template`` of the lines that have a general one.

    The support of a token is the number of rows of its leaf that have it at its place. Of
    a line's supports in falling order, the one that the least number of constants reaches
    is the line's usual support; tokens with ``SHARE_PERCENT`` of that are constants. So
    all counts may grow alike, and no value of a field becomes a constant by number alone.

    The leading tokens are in common to the leaf and say nothing, nor do tokens with digits:
    only words after them count as constants, ``MIN_CONSTANTS`` at least and
    ``min_constant_percent`` of the places after the leading ones.

    A template is a hash of the constants and their places; as many rows must have them
    together, or words met by chance. Lines that have too few constants, or neither a
    variable field nor a token with digits, are not in the result.
    """
    # Spark would size stored tables by their files and exploded ones by what they come from: no join may broadcast.
    several = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("leaf")
    varied = lines.join(store(several, "template-leaves").hint("merge"), "leaf", "left_semi")
    tail = F.slice("tokens", depth + 1, F.size("tokens"))
    places = (
        varied.select(
            "leaf",
            "line",
            "rows",
            F.size(tail).alias("n"),
            F.array_contains(F.slice("tokens", 1, depth), _FIELD_HASH).alias("field"),
            F.posexplode(tail).alias("place", "token"),
        )
        .filter((F.col("n") >= MIN_CONSTANTS) & (F.col("token") != _FIELD_HASH))
    )
    # Stored, as are the right sides of the joins below: Spark splits the rows of a common key only
    # if both sides come fresh from a shuffle.
    supports = store(
        places.groupBy("leaf", "place", "token")
        .agg(F.sum("rows").alias("support"))
        .filter(F.col("support") >= min_docs),
        "template-supports",
    )
    frequent = places.join(supports.hint("merge"), ["leaf", "place", "token"]).select("leaf", "line", "n", "field", "rows", "place", "token", "support")
    found = (
        frequent.groupBy("leaf", "line")
        .agg(
            F.first("n").alias("n"),
            F.first("field").alias("field"),
            F.first("rows").alias("rows"),
            F.sort_array(F.collect_list(F.struct("support", "place", "token")), asc=False).alias("at"),
        )
        .withColumn("least", F.greatest(F.lit(MIN_CONSTANTS), F.ceil(F.col("n") * min_constant_percent / 100).cast("int")))
        .filter(F.size("at") >= F.col("least"))
        .withColumn("usual", F.element_at("at", F.col("least"))["support"])
        .withColumn("at", F.filter("at", lambda x: 100 * x["support"] >= SHARE_PERCENT * F.col("usual")))
    )
    varies = F.col("field") | (F.size("at") < F.col("n"))
    constants = F.sort_array(F.transform("at", lambda x: F.struct(x["place"], x["token"])))
    templates = store(
        found.filter(varies).select("leaf", "line", "rows", "usual", F.xxhash64(constants).alias("template")),
        "template-found",
    )
    together = templates.groupBy("leaf", "template").agg(F.sum("rows").alias("rows"), F.max("usual").alias("usual"))
    true = store(
        together.filter(100 * F.col("rows") >= SHARE_PERCENT * F.col("usual")).select("leaf", "template"), "template-true"
    )
    return templates.select("leaf", "line", "template").join(true.hint("merge"), ["leaf", "template"], "left_semi")


def _row(id_column: str, text_column: str) -> Column:
    """A hash that stands for a row: rows of the same id and text are the same row."""
    return F.xxhash64(
        F.coalesce(F.col(quoted(id_column)).cast("string"), F.lit("")),
        F.col(quoted(id_column)).isNull(),
        F.coalesce(F.col(quoted(text_column)), F.lit("")),
    )


def _firsts(placed: DataFrame, group: str, min_docs: int) -> DataFrame:
    """``leaf, <group>, first_row, first_line`` of the groups that ``min_docs`` different documents have."""
    # Different documents first, in each task; then how many a group has.
    documents = placed.groupBy("leaf", group, "row").agg(
        F.min(F.struct(F.col("doc").isNull().alias("no_id"), "doc", "row", "line_no")).alias("first")
    )
    return (
        documents.groupBy("leaf", group)
        .agg(F.count(F.lit(1)).alias("docs"), F.min("first").alias("first"))
        .filter(F.col("docs") >= min_docs)
        .select("leaf", group, F.col("first.row").alias("first_row"), F.col("first.line_no").alias("first_line"))
    )


def repeated_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    exact_docs: int = EXACT_DOCS,
    depth: int = DEPTH,
    min_tokens: int = MIN_TOKENS,
    min_constant_percent: int = MIN_CONSTANT_PERCENT,
    bits: int = BITMAP_BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``row, line_no``: the lines to be dropped, all of a recurring template or line but its first.

    A general template recurs in ``min_docs`` documents, a line of the same tokens in ``exact_docs``.
    First is the smallest (id, row, line number), null ids last. ``row`` is the hash of id and text.
    """
    slim = docs.select(
        _row(id_column, text_column).alias("row"), F.col(quoted(id_column)).alias("doc"), F.col(quoted(text_column)).alias("text")
    )
    leaves = recurring_leaves(slim.select("text"), min(min_docs, exact_docs), depth, min_tokens)
    marked = candidate_lines(slim, bitmap_of(leaves, bits), depth, min_tokens, bits)
    candidates = store(marked, "template-lines")
    lines = store(
        candidates.groupBy("leaf", "line").agg(
            F.first("tokens").alias("tokens"),
            F.count(F.lit(1)).alias("rows"),
        ),
        "template-distinct",
    )
    named = store(line_templates(lines, min_docs, depth, min_constant_percent), "template-names")
    placed = candidates.select("row", "doc", "line_no", "leaf", "line")
    templates = store(_firsts(placed.join(named.hint("merge"), ["leaf", "line"]), "template", min_docs), "template-recurring")
    general = store(named.join(templates.hint("merge"), ["leaf", "template"]).drop("template"), "template-general")
    exact = store(_firsts(placed, "line", exact_docs), "template-exact")
    firsts = store(general.unionByName(exact.join(general.hint("merge"), ["leaf", "line"], "left_anti")), "template-firsts")
    again = placed.join(firsts.hint("merge"), ["leaf", "line"]).filter(
        (F.col("row") != F.col("first_row")) | (F.col("line_no") != F.col("first_line"))
    )
    return again.select("row", "line_no")


def drop_repeated_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    counts: bool = False,
    **options,
) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text; with ``counts`` also n_lines and n_dropped.

    Those two replace columns of their names. All other rows and columns stay; a text of which every line is dropped becomes empty. Null
    texts stay null, empty ones empty. Rows with the same id and text are one document;
    null ids are told apart by their text. Lines of fewer than ``min_tokens`` tokens stay. An
    empty table gives an empty table.
    """
    kept = docs.drop("n_lines", "n_dropped") if counts else docs
    row, gone = unused_name(kept, "__row"), unused_name(kept, "__drops")
    drops = (
        repeated_lines(docs, id_column=id_column, text_column=text_column, **options)
        .groupBy(F.col("row").alias(row))
        .agg(F.collect_set("line_no").alias(gone))
    )
    marked = kept.withColumn(row, _row(id_column, text_column)).join(drops.hint("merge"), row, "left").drop(row)
    at = kept.columns.index(text_column)
    names = [*kept.columns, *(["n_lines", "n_dropped"] if counts else [])]
    n_columns = len(kept.columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, numbers = [], [], []
            for cell, drop in zip(batch.column(at), batch.column(n_columns)):
                text, gone = cell.as_py(), set(drop.as_py() or ())
                total = 0 if text is None else text.count("\n") + 1
                if gone:
                    text = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone)
                texts.append(text)
                totals.append(total)
                numbers.append(len(gone))
            columns = [batch.column(k) for k in range(n_columns)]
            columns[at] = pa.array(texts, pa.string())
            if counts:
                columns += [pa.array(totals, pa.int64()), pa.array(numbers, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = kept.schema
    if counts:
        schema = kept.withColumn("n_lines", F.lit(0).cast("long")).withColumn("n_dropped", F.lit(0).cast("long")).schema
    return map_batches(marked, work, schema)
