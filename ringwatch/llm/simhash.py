"""SimHash near-duplicates with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments, each padded to the 23 bits of the
perfect binary Golay code. Every 23-bit string lies within three bits of exactly
one codeword, its home. If two strings differ in one bit at most, the home of one
lies within four bits of the other; the codewords within four bits are its near
codewords, one or six of them. So a join of homes with near codewords tolerates
one error in a segment.

Pigeonhole: three differing bits over three segments leave either one segment
equal and another with one error at most, or one error in each of the three.
The first case is found by keys (equal segment, codeword of another), the second by
keys of three codewords; at least 33 bits either way. Joined pairs are verified on
all 64 bits.

Only different fingerprints are joined, so that copies cost nothing. A key of
fingerprints that lie close together holds a number of them that is bounded by the
number of patterns of a few bits, not by the size of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ringwatch.llm.components import connected_components
from ringwatch.llm.tasks import map_batches, quoted, unused_name
from ringwatch.session import store

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
#: Fingerprints of which one task makes the keys.
FINGERPRINTS_PER_TASK = 20_000

#: The code's length, and its generator x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
LENGTH = 23
GENERATOR = 0b110001110101

#: First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: (equal segment, segment with one error at most), in the order in which a pair is looked for.
COMBINATIONS = tuple((i, j) for i in range(3) for j in range(3) if i != j)

# Shingles of one text that are expanded to bits at a time.
_BLOCK = 1 << 14
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text as an unsigned number; 0 if it has no word."""
    words = text.translate(_LOWER).split()  # bytes are split at ASCII white space only
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*[words[k:] for k in range(shingle_words)])))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=len(shingles))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _BLOCK):
        part = hashes[at : at + _BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprint(rows: DataFrame, text_column: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``rows`` with ``fp``, a signed 64-bit number, in place of the text."""
    others = [c for c in rows.columns if c != text_column]
    at = rows.columns.index(text_column)
    rest = [k for k in range(len(rows.columns)) if k != at]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            found = np.array([fingerprint(t.as_py() or b"", shingle_words) for t in texts], dtype=np.uint64)
            kept = [batch.column(k) for k in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found.view(np.int64))], [*others, "fp"])

    schema = StructType([*[f for f in rows.schema.fields if f.name != text_column], StructField("fp", LongType())])
    return map_batches(rows, work, schema)


def _syndromes(vectors: np.ndarray) -> np.ndarray:
    """The remainders of 23-bit vectors by the generator."""
    rest = vectors.copy()
    for bit in range(LENGTH - 1, 10, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
    return rest


@lru_cache(maxsize=1)
def _error_patterns() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the pattern of up to three bits, and the patterns of four bits with how many there are."""
    home = np.zeros(2048, dtype=np.int64)
    for weight in range(1, 4):
        for places in combinations(range(LENGTH), weight):
            pattern = sum(1 << p for p in places)
            home[_syndromes(np.array([pattern]))[0]] = pattern
    fours = np.array([sum(1 << p for p in places) for places in combinations(range(LENGTH), 4)])
    near = np.zeros((2048, 6), dtype=np.int64)
    near[:, 0] = home
    count = np.ones(2048, dtype=np.int64)
    for syndrome, pattern in zip(_syndromes(fours), fours):
        near[syndrome, count[syndrome]] = pattern
        count[syndrome] += 1
    return home, near, count


def home_codeword(segment: np.ndarray) -> np.ndarray:
    """The index of the one codeword within three bits of each segment."""
    home, _, _ = _error_patterns()
    return (segment ^ home[_syndromes(segment)]) >> 11


def near_codewords(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all codewords within four bits: the row of each segment, and the index."""
    _, near, count = _error_patterns()
    syndrome = _syndromes(segment)
    n = count[syndrome]
    row = np.repeat(np.arange(len(segment)), n)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return row, (segment[row] ^ near[syndrome[row], nth]) >> 11


def _cross(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int):
    """All pairs of two lists per row: the row, the value of each."""
    count = np.bincount(b[0], minlength=n)
    start = np.cumsum(count) - count
    times = count[a[0]]
    row = np.repeat(a[0], times)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    return row, np.repeat(a[1], times), b[1][start[row] + nth]


def join_keys(fps: np.ndarray) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
    """The keys of fingerprints: (whether of the home side, the row of the fingerprint, the key)."""
    n = len(fps)
    segments = [((fps >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    rows = np.arange(n)
    homes = [home_codeword(s) for s in segments]
    nears = [near_codewords(s) for s in segments]
    for kind, (i, j) in enumerate(COMBINATIONS):
        equal = kind << 36 | segments[i] << 12
        yield True, rows, equal | homes[j]
        row, codeword = nears[j]
        yield False, row, equal[row] | codeword
    kind = len(COMBINATIONS) << 36
    row, codeword = nears[2]
    yield True, row, kind | homes[0][row] << 24 | homes[1][row] << 12 | codeword
    row, first, second = _cross(nears[0], nears[1], n)
    yield False, row, kind | first << 24 | second << 12 | homes[2][row]


def _kind_of(difference: Column) -> Column:
    """The first kind of key under which two fingerprints that differ so must meet."""
    errors = [
        F.bit_count(difference.bitwiseAND(F.lit(int(np.uint64(((1 << width) - 1) << at).view(np.int64)))))
        for at, width in SEGMENTS
    ]
    kind = F.lit(len(COMBINATIONS))
    for k, (i, j) in reversed(list(enumerate(COMBINATIONS))):
        kind = F.when((errors[i] == 0) & (errors[j] <= 1), F.lit(k)).otherwise(kind)
    return kind


def near_fingerprints(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp`` (each once) -> ``a, b``: every pair a < b that differs in ``max_bits`` bits at most, once."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys find pairs of up to {MAX_BITS} differing bits, not {max_bits}")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(signed), 4096):
                block = signed[at : at + 4096]
                for home, row, key in join_keys(block.view(np.uint64)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(block[row]), pa.array(np.full(len(row), home))],
                        ["key", "fp", "home"],
                    )

    # A fingerprint becomes some 71 rows: tasks are cut by number, not by the few bytes that they read.
    tasks = max(1, math.ceil(fingerprints.count() / FINGERPRINTS_PER_TASK))
    dealt = fingerprints.select("fp").repartition(tasks, "fp")
    keyed = map_batches(dealt, work, "key long, fp long, home boolean")
    left = keyed.filter("home").select("key", F.col("fp").alias("a"))
    right = keyed.filter("not home").select("key", F.col("fp").alias("b"))
    difference = F.col("a").bitwiseXOR(F.col("b"))
    # Spark sizes the keys by the fingerprints they are made of, a seventieth of them, and would broadcast them.
    return left.join(
        right.hint("merge"),
        (left["key"] == right["key"])
        & (F.col("a") < F.col("b"))
        & (F.bit_count(difference) <= max_bits)
        # A pair may meet under several keys; it counts under the first.
        & (F.shiftright(left["key"], 36) == _kind_of(difference)),
    ).select("a", "b")


def group_firsts(prints: DataFrame, key: str, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, first``: for each fingerprint the smallest ``key`` of all rows that links reach."""
    classes = store(prints.groupBy("fp").agg(F.min(key).alias("smallest")), "simhash-classes")
    # None of these tables is bounded, and files are smaller than their rows: nothing is broadcast by its size.
    members = connected_components(near_fingerprints(classes, max_bits))  # fingerprints with links only
    named = (
        members.join(classes.hint("merge"), members["node"] == classes["fp"])
        .groupBy("component")
        .agg(F.min("smallest").alias("least"))
    )
    linked = members.join(named.hint("merge"), "component").select(F.col("node").alias("fp"), "least")
    return classes.join(linked.hint("merge"), "fp", "left").select("fp", F.coalesce("least", "smallest").alias("first"))


def simhash_groups(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits), component_id.

    Fingerprints that differ in ``max_bits`` bits at most are linked; the component is
    the smallest id that links reach. Words are separated by ASCII white space, A to Z
    count as a to z; a text of fewer words than a shingle is one shingle.

    Null and empty texts have fingerprint 0 and are linked like any other. Rows with
    the same id are each returned; null ids are returned, but name a component only
    if no other id is in it (null then). Other columns are not read. An empty table
    gives an empty table.
    """
    slim = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    prints = store(with_fingerprint(slim, "text", shingle_words), "simhash-prints")
    firsts = group_firsts(prints, "doc_id", max_bits)
    # Both sides are read anew, so that Spark can split the rows of a common fingerprint.
    return prints.join(store(firsts, "simhash-firsts").hint("merge"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id")
    )


def drop_near_copies(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that are first of their group, with all their columns.

    First is the smallest id, null ids last, and of equal ids a text picked by its hash;
    of rows that are equal in id and text one stays. The rest as in :func:`simhash_groups`.
    """
    name = unused_name(docs, "__row")
    row = F.xxhash64(
        F.coalesce(F.col(quoted(id_column)).cast("string"), F.lit("")),
        F.col(quoted(id_column)).isNull(),
        F.coalesce(F.col(quoted(text_column)), F.lit("")),
    )
    slim = docs.select(
        F.struct(F.col(quoted(id_column)).isNull().alias("no_id"), F.col(quoted(id_column)).alias("id"), row.alias("row")).alias("key"),
        F.col(quoted(text_column)).alias("text"),
    )
    prints = store(with_fingerprint(slim, "text", shingle_words), "simhash-prints")
    firsts = group_firsts(prints, "key", max_bits).select(F.col("first.row").alias(name)).distinct()
    kept = docs.withColumn(name, row).join(firsts.hint("merge"), name)
    return kept.dropDuplicates([name]).select(*[F.col(quoted(c)) for c in docs.columns])
