"""Mixing sources to target weights with hash-threshold histograms.

Every source gets a word budget. A budget of several times a source's size takes
every document that many whole times; what is left of the budget is met by the
documents whose hash lies below a threshold. The threshold is found without
sorting documents: words are summed by source and hash bucket, the bucket in
which the budget runs out is cut into finer buckets, and so on. Larger budgets
have larger thresholds, so that a mix for a smaller budget is part of the larger.

Everything is DataFrame functions; rows never leave the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringwatch.llm.tasks import quoted, unused_name
from ringwatch.operators.ordered import row_numbers
from ringwatch.session import store

WORD = r"[^\x20\x09-\x0D]+"
LEVEL_BITS = 12
LEVELS = 4
HASH_BITS = LEVEL_BITS * LEVELS


def word_count(text: Column) -> Column:
    """Words of a text; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hash(id_column: str, text_column: str) -> Column:
    """48 bits that depend on id and text alone, so that reruns and lost tasks agree."""
    digests = [F.md5(F.coalesce(F.col(quoted(c)).cast("string"), F.lit(""))) for c in (id_column, text_column)]
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), *digests)), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """``source, source_size`` -> the same with ``target``.

    Weights are dealt to the sources in code point order, null last. A target above
    ``cap`` times its source's size is cut to that, and what it leaves goes to the
    other sources by weight, again and again until no target is above.
    """
    dealt = F.element_at(
        F.array(*[F.lit(w) for w in weights]), ((F.col("row_no") - 1) % len(weights) + 1).cast("int")
    )
    table = store(
        row_numbers(sizes, [F.col("source").asc_nulls_last()])
        .withColumn("weight", dealt.cast("long"))
        .drop("row_no"),
        "mix-sources",
    )
    # One row comes to the driver in each round; a round more only if a further source was cut.
    words = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    most = F.col("source_size") * cap
    open_words, open_weight, cut = words, None, -1
    above = F.lit(False)
    while True:
        row = table.agg(
            F.coalesce(F.sum(F.when(above, F.lit(1)).otherwise(0)), F.lit(0)).alias("cut"),
            F.coalesce(F.sum(F.when(above, most)), F.lit(0)).alias("spent"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        if row["cut"] == cut:
            break
        cut, open_words, open_weight = row["cut"], words - row["spent"], row["open"]
        if not open_weight:
            break
        share = F.col("weight").cast("double") * float(open_words) / float(open_weight)
        above = share > most
    if not open_weight:
        return table.withColumn("target", most.cast("double")).drop("weight")
    return table.withColumn(
        "target",
        F.when(above, most.cast("double")).otherwise(
            F.col("weight").cast("double") * float(open_words) / float(open_weight)
        ),
    ).drop("weight")


def _thresholds(slim: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, rest`` -> ``source, threshold``: documents hashed below it are taken once more.

    The documents below sum to at most ``rest``; the one in which it runs out is
    taken too if that comes nearer. Documents with equal hashes go together.
    """
    state = budgets.select("source", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))
    for level in range(LEVELS):
        kept_bits = LEVEL_BITS * (level + 1)
        finer = slim.select(
            "source",
            "size",
            F.shiftright("hash", HASH_BITS - kept_bits + LEVEL_BITS).alias("prefix"),
            F.shiftright("hash", HASH_BITS - kept_bits).alias("bucket"),
        )
        same = [F.col("s.source").eqNullSafe(F.col("b.source"))]
        if level:  # only the boundary buckets are looked into again; their keys are even
            same.append(F.col("s.prefix") == F.col("b.prefix"))
            finer = finer.alias("s").join(
                state.select("source", "prefix").alias("b"), same, "left_semi"
            )
        buckets = finer.groupBy("source", "prefix", "bucket").agg(F.sum("size").alias("words"))
        upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        summed = buckets.withColumn("upto", F.sum("words").over(upto))
        placed = summed.alias("s").join(state.alias("b"), same)
        ends = F.col("b.before") + F.col("s.upto")
        state = (
            placed.filter(ends > F.col("b.rest"))
            .groupBy(F.col("b.source").alias("source"))
            .agg(
                F.min_by(
                    F.struct(
                        F.col("b.rest").alias("rest"),
                        F.col("s.bucket").alias("prefix"),
                        (ends - F.col("s.words")).alias("before"),
                        F.col("s.words").alias("words"),
                    ),
                    F.col("s.bucket"),
                ).alias("at")
            )
            .select("source", "at.*")
        )
    nearer = 2 * (F.col("rest") - F.col("before")) > F.col("words")
    return state.select("source", (F.col("prefix") + nearer.cast("long")).alias("threshold"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    cap: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    into: str = "mix",
) -> DataFrame:
    """All rows and columns of ``docs`` with a struct ``into``: size, source_size, target, copies, taken.

    ``copies`` is how often the document is in the mix (0 to ``cap``), ``taken`` its
    words times that. The targets of all sources add up to the words of the corpus.

    Null and empty texts have size 0 and count for nothing; a null source is a source,
    the last; a source without words has target 0. Rows with the same id and the same
    text share their fate; rows of one id or of none with different texts do not. An empty table gives an empty table. A column that
    has the name of ``into`` already is replaced; other columns stay whatever their names.
    """
    slim = store(
        docs.select(
            F.col(quoted(source_column)).cast("string").alias("source"),
            word_count(F.col(quoted(text_column))).alias("size"),
            _hash(id_column, text_column).alias("hash"),
        ),
        "mix-sizes",
    )
    targets = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    rounds = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(cap)))
    budgets = targets.withColumn("rounds", F.coalesce(rounds, F.lit(0)).cast("int")).withColumn(
        "rest", F.col("target") - F.col("rounds") * F.col("source_size")
    )
    budgets = store(budgets, "mix-budgets")
    thresholds = _thresholds(slim, budgets.filter("rest > 0"))
    # One row per source, read back from files: Spark broadcasts it only if its size allows that.
    rows = docs.drop(into)
    plan, joined_on = unused_name(rows, "__plan"), unused_name(rows, "__source")
    per_source = store(
        budgets.alias("b")
        .join(thresholds.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")), "left")
        .select(
            F.col("b.source").alias(joined_on),
            F.struct("source_size", "target", "rounds", F.coalesce("threshold", F.lit(0)).alias("threshold")).alias(plan),
        ),
        "mix-thresholds",
    )
    joined = rows.join(per_source, F.col(quoted(source_column)).cast("string").eqNullSafe(F.col(joined_on)), "left")
    copies = F.col(f"{plan}.rounds") + (_hash(id_column, text_column) < F.col(f"{plan}.threshold")).cast("int")
    size = word_count(F.col(quoted(text_column)))
    return joined.select(
        *[F.col(quoted(c)) for c in rows.columns],
        F.struct(
            size.alias("size"),
            F.col(f"{plan}.source_size").alias("source_size"),
            F.col(f"{plan}.target").alias("target"),
            copies.alias("copies"),
            (size * copies).alias("taken"),
        ).alias(into),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, columns as in ``docs``."""
    name = unused_name(docs, "__mix")
    copy = unused_name(docs, "__copy")
    chosen = mix(docs, into=name, **options).filter(F.col(f"{name}.copies") > 0)
    copies = F.explode(F.array_repeat(F.lit(0), F.col(f"{name}.copies")))
    return chosen.withColumn(copy, copies).select(*[F.col(quoted(c)) for c in docs.columns])
