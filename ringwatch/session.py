"""Session helpers: a local session for tests and the durable cut of a lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import ringwatch

_SENT: set[str] = set()


def local_session(
    cores: int | str = 8, app: str = "ringwatch", checkpoints: str | None = None
) -> SparkSession:
    """A local[N] session for tests and the benchmark; ``checkpoints`` is the folder of stored stages."""
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    if checkpoints:
        builder = builder.config("spark.checkpoint.dir", checkpoints)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``; the session helper, tests and the
    benchmark do so too. Only a local session in which nothing is set falls back to a
    temporary folder: on a cluster that would be lost with a node.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="ringwatch-checkpoints-")
    spark.sparkContext.setCheckpointDir(shared)
    return spark.sparkContext.getCheckpointDir()


@contextmanager
def job(spark: SparkSession) -> Iterator[str]:
    """A job's own folder for everything it stores, removed at its end, also after a failure.

    Results that are read lazily must be written or collected before the end. Jobs may
    follow one another, not be nested.
    """
    context = spark.sparkContext
    outer = checkpoint_root(spark).rpartition("/")[0]
    context.setCheckpointDir(outer)  # makes a new folder below it
    folder = context.getCheckpointDir()
    try:
        yield folder
    finally:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        context.setCheckpointDir(outer)


def freeze(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from the written rows.

    Partition layout and row order are then fixed, whatever executors are lost.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    The stage boundary of a job: later steps read only the columns they need, and
    nothing before it is computed twice. Within :func:`job` the table goes with the job.
    ``options`` are those of Spark's Parquet writer.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def send_package(spark: SparkSession) -> None:
    """Let the executors import this package, once per application.

    The driver packs its own copy and Spark's file server hands it out, so that
    nothing has to be installed or shared beforehand.
    """
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    root = Path(ringwatch.__file__).resolve().parent
    packed = Path(tempfile.mkdtemp(prefix="ringwatch-")) / "ringwatch.zip"
    with zipfile.ZipFile(packed, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    context.addPyFile(str(packed))
    _SENT.add(context.applicationId)
