import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from ringwatch.session import local_session  # noqa: E402


def pytest_collection_modifyitems(items):
    # A model that Spark has just fitted drags the session into its tasks, and a session in which a test has
    # observed something cannot be sent: the test that lets such a model score comes first.
    items.sort(key=lambda item: not item.name.startswith("test_the_forest_is_as_good_as_one_of_spark"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "ringwatch-tests")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    # Small inputs must still be cut into several slices.
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    # Plans are read as text, so they must not be cut short.
    session.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def raw(spark, folder):
    from ringwatch.sources.event_calls import read_event_calls

    return read_event_calls(spark, folder).cache()


@pytest.fixture(scope="session")
def labelled(raw):
    from ringwatch.plans.prepare import labelled_table

    return labelled_table(raw).cache()


@pytest.fixture(scope="session")
def data(raw):
    from ringwatch.plans.prepare import training_table

    return training_table(raw)


@pytest.fixture
def calls(spark):
    """Build a frame of calls with ``ts`` from dicts; what is left out is null."""
    from ringwatch.schema import CALLS

    def build(*rows):
        types = {f.name: f.dataType.simpleString() for f in CALLS.fields}
        types.update(ts="string", is_fraud="int")
        names = list(dict.fromkeys(n for r in rows for n in r))
        df = spark.createDataFrame(
            [tuple(r.get(n) for n in names) for r in rows], ", ".join(f"`{n}` {types[n]}" for n in names)
        )
        if "ts" in names:
            df = df.withColumn("ts", df["ts"].cast("timestamp_ntz"))
        return df

    return build
