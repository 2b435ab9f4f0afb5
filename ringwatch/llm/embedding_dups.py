"""Embedding near-duplicates: one small-world graph per shard, every shard queried.

Equal vectors are one class first, so that copies cost one node. The classes of a label
are dealt to shards of bounded size by a hash. Each shard builds its graph and audits it: for
probes that are turned away from its own vectors just as far as a link reaches, for vectors that
have near ones, and for visitors from other shards, the true neighbours are found by a full
scan, and the beam is widened, up to the whole shard, until the search finds enough of
them. Then all classes of a label are looked up in
every shard of that label, in chunks of bounded size, and links are verified by the
cosine in double precision. A chunk and a shard give the number of links of each query and
a spanning forest of those links, so that a dense group never becomes a table of its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.components import connected_components
from ringwatch.llm.hnsw import Hnsw
from ringwatch.session import send_package, store

THRESHOLD = 0.98
#: Vectors of a shard, and of a chunk that is looked up at once (about, as a hash deals them).
SHARD_ROWS = 8192
CHUNK_ROWS = 2048
#: Vectors with partners that are audited, as many of other shards, and as many probes.
AUDITED = 512
PROBES = 256
#: Vectors whose partners are looked for at once.
AUDIT_BLOCK = 512
#: The share of their links that a search must find, the first beam.
AUDIT_RECALL = 0.98
FIRST_BEAM = 16
# Searches look a little wider than the threshold, for the graph has single precision.
SLACK = 1e-5


def _unit(vectors: np.ndarray) -> np.ndarray:
    # The largest component first, so that no square overflows or vanishes.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _with_partners(units: np.ndarray, queries: np.ndarray, own: np.ndarray | None, threshold: float) -> list[tuple]:
    """(query, its true neighbours) of the queries that have any, up to ``AUDITED``; ``own`` are their rows in ``units``."""
    found: list[tuple] = []
    for start in range(0, len(queries), AUDIT_BLOCK):
        block = queries[start : start + AUDIT_BLOCK]
        near = block @ units.T >= threshold
        if own is not None:
            near[np.arange(len(block)), own[start : start + AUDIT_BLOCK]] = False
        for k in np.flatnonzero(near.any(axis=1)):
            found.append((block[k].astype(np.float32), set(np.flatnonzero(near[k]).tolist())))
            if len(found) == AUDITED:
                return found
    return found


def _probes(units: np.ndarray, threshold: float) -> np.ndarray:
    """Vectors turned away from some of ``units`` by angles up to that of the threshold, the same on every run."""
    rng = np.random.default_rng(len(units))
    base = units[rng.choice(len(units), min(PROBES, len(units)), replace=False)]
    aside = rng.normal(size=base.shape)
    aside -= (aside * base).sum(axis=1, keepdims=True) * base
    length = np.linalg.norm(aside, axis=1, keepdims=True)
    # In one dimension there is no way aside.
    aside = np.divide(aside, length, out=np.zeros_like(aside), where=length > 1e-9)
    cosine = np.linspace(threshold, 1.0, len(base) + 2)[1:-1, None]
    return _unit(cosine * base + np.sqrt(1 - cosine * cosine) * aside)


def audited_beam(graph: Hnsw, units: np.ndarray, threshold: float, others: np.ndarray | None = None) -> tuple[int, float]:
    """The first beam that finds enough, and the recall it has in the audit; beam 0 means: scan the shard.

    Three sides are audited, each over all its links and as the mean of its queries: probes
    beside the shard's own vectors, which every shard has, vectors that have partners (a vector is no partner
    of itself), and ``others``, vectors of other shards. The recall is the least of all. Only
    a graph that fails with a beam as wide as the shard is left for a scan.
    """
    # A stride that shares no factor with the number of rows, so that each comes once.
    stride = next(k for k in range(max(1, int(0.618 * len(units))), len(units) + 2) if math.gcd(k, len(units)) == 1)
    order = np.arange(len(units)) * stride % len(units)
    sides = [_with_partners(units, _probes(units, threshold), None, threshold)]
    sides.append(_with_partners(units, units[order], order, threshold))
    if others is not None and len(others):
        sides.append(_with_partners(units, others, None, threshold))
    beam = FIRST_BEAM
    while True:
        recall = 1.0
        for side in filter(None, sides):
            sizes = np.array([len(truth) for _, truth in side])
            met = np.array([len(truth.intersection(graph.within(q, threshold - SLACK, beam))) for q, truth in side])
            recall = min(recall, float(met.sum() / sizes.sum()), float((met / sizes).mean()))
        if recall >= AUDIT_RECALL:
            return beam, recall
        if beam >= len(units):
            return 0, 1.0
        beam *= 2


def _usable(vector: Column, label: Column) -> Column:
    """Not null, not zero, only finite components; with a label."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(label.isNotNull() & vector.isNotNull() & finite & some, F.lit(False))


def _deal(key: str, salt: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(salt)), parts).cast("int")


def build_shards(classes: DataFrame, threshold: float) -> DataFrame:
    """``label, dim, shard, n_chunks, beam, recall, ids, copies, raw, graph``: a graph per shard, with its audit."""
    send_package(classes.sparkSession)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id")
        others = rows[rows["guest"]]
        rows = rows[~rows["guest"]]
        if not len(rows):  # the hash dealt nothing else to this shard
            return pd.DataFrame(columns=names)
        raw = _matrix(rows["vector"])
        units = _unit(raw)
        graph = Hnsw(units, rows["vec_id"].tolist())
        beam, recall = audited_beam(graph, units, threshold, _unit(_matrix(others["vector"])) if len(others) else None)
        first = rows.iloc[0]
        return pd.DataFrame(
            {
                "label": [first["label"]],
                "dim": [first["dim"]],
                "shard": [first["shard"]],
                "n_chunks": [first["n_chunks"]],
                "beam": [beam],
                "recall": [recall],
                "ids": [rows["vec_id"].tolist()],
                "copies": [rows["copies"].tolist()],
                "raw": [raw.astype(np.float32 if single else np.float64).tobytes()],
                "graph": [graph.to_bytes()],
            }
        )

    types = dict(classes.dtypes)
    single = types["vector"] == "array<float>"
    schema = (
        f"label {types['label']}, dim int, shard int, n_chunks int, beam int, recall double, "
        f"ids array<{types['vec_id']}>, copies array<long>, raw binary, graph binary"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    # About AUDITED vectors visit each shard from the others, for its audit.
    drawn = F.pmod(F.xxhash64("vec_id", F.lit("guest")), F.lit(SHARD_ROWS)) < AUDITED
    away = 1 + F.pmod(F.xxhash64("vec_id", F.lit("host")), F.col("n_shards") - 1)
    guests = classes.filter((F.col("n_shards") > 1) & drawn).withColumn(
        "shard", ((F.col("shard") + away) % F.col("n_shards")).cast("int")
    )
    audience = classes.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    keys = ["label", "dim", "shard"]
    # A task per shard or so: Spark would merge tasks by their bytes, but a graph is work, not bytes.
    shards = classes.select(*keys).distinct().count()
    return audience.repartition(max(2 * shards, 1), *keys).groupBy(*keys).applyInPandas(build, schema)


def _search(shard: pd.DataFrame, queries: pd.DataFrame, threshold: float, single: bool) -> pd.DataFrame:
    """For each query the rows linked to it in one shard; and a spanning forest of these links as ``other``."""
    counts: list[tuple] = []
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    forest: list[tuple] = []
    if len(shard) and len(queries):
        row = shard.iloc[0]
        graph, beam = Hnsw.from_bytes(row["graph"]), int(row["beam"])
        ids, copies = np.asarray(row["ids"]), np.asarray(row["copies"])
        raw = np.frombuffer(row["raw"], np.float32 if single else np.float64).reshape(len(ids), -1).astype(np.float64)
        norms = np.sqrt((raw * raw).sum(axis=1))
        wanted = _matrix(queries["vector"])
        lengths = np.sqrt((wanted * wanted).sum(axis=1))
        wide = threshold - SLACK
        for vec_id, query, length, unit in zip(queries["vec_id"], wanted, lengths, _unit(wanted).astype(np.float32)):
            met = graph.within(unit, wide, beam) if beam else np.flatnonzero(graph.vectors @ unit >= wide)
            met = np.array(met, dtype=np.int64)
            near = met[(raw[met] @ query) / (norms[met] * length) >= threshold]
            near = near[ids[near] != vec_id]
            if not len(near):
                continue
            counts.append((vec_id, int(copies[near].sum()), None))
            here = find(vec_id)
            for other in ids[near].tolist():
                there = find(other)
                if there != here:
                    root[there] = here
                    forest.append((vec_id, 0, other))
    return pd.DataFrame(counts + forest, columns=["vec_id", "linked", "other"]).astype({"other": "Int64"})


def near_vectors(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, label, dim, vector, copies`` (each vector once per label) -> ``vec_id, linked, other``.

    A row without ``other`` has the number of rows that ``vec_id`` is linked to in some
    shard; the links to ``other`` connect what all links together connect.
    """
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    parts = sizes.select(
        "label",
        "dim",
        F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("n_shards"),
        F.ceil(F.col("n") / CHUNK_ROWS).cast("int").alias("n_chunks"),
    )
    dealt = store(
        classes.join(parts, ["label", "dim"]).select(
            "*",
            _deal("vec_id", "shard", F.col("n_shards")).alias("shard"),
            _deal("vec_id", "chunk", F.col("n_chunks")).alias("chunk"),
        ),
        "hnsw-vectors",
    )
    graphs = store(build_shards(dealt, threshold), "hnsw-graphs")
    keys = ["label", "dim", "shard", "chunk"]
    shards = graphs.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
    queries = dealt.drop("shard").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1)))
    types = dict(classes.dtypes)
    single = types["vector"] == "array<float>"
    return (
        shards.select(*keys, "beam", "ids", "copies", "raw", "graph")
        .groupBy(*keys)
        .cogroup(queries.select(*keys, "vec_id", "vector").groupBy(*keys))
        .applyInPandas(
            lambda left, right: _search(left, right, threshold, single),
            f"vec_id {types['vec_id']}, linked long, other {types['vec_id']}",
        )
    )


def embedding_groups(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors of one label (and one length) are linked if their cosine is ``threshold`` or
    more. ``n_links`` counts the other rows a row is linked to, ``component_id`` is the
    smallest id that links reach, ``kept`` tells whether that is the row's own.

    Vectors that are null, zero or hold null or non-finite components, and rows without a
    label or id, link with nothing; a null id is its own component (null) and kept. Rows
    that repeat an id and its vector are linked like copies; rows of one id with different
    vectors are one node, so that a link of one is a link of all. Other columns are not
    read. An empty table gives an empty table.
    """
    rows = vectors.select(
        F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector")
    )
    usable = _usable(F.col("vector"), F.col("label")) & F.col("vec_id").isNotNull()
    good = rows.filter(usable).withColumn("dim", F.size("vector"))
    classes = store(
        good.groupBy("label", "dim", "vector")
        .agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
        .select("vec_id", "label", "dim", "vector", "copies"),
        "hnsw-classes",
    )
    found = store(near_vectors(classes, threshold), "hnsw-links")
    others = found.groupBy("vec_id").agg(F.sum("linked").alias("linked"))
    links = found.filter("other is not null").select(F.col("vec_id").alias("a"), F.col("other").alias("b"))
    members = connected_components(links).select(F.col("node").alias("vec_id"), "component")
    whole = (
        classes.join(others, "vec_id", "left")
        .join(members, "vec_id", "left")
        .select(
            "label",
            "vector",
            (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
    )
    # Both sides are read anew, so that Spark can split the rows of a common vector.
    linked = good.join(store(whole, "hnsw-whole"), ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
