"""Tables that grow with the documents are never broadcast, however small Spark takes them to be."""

import pytest

from ringwatch.llm import components, simhash, templates


@pytest.fixture
def plans(spark, monkeypatch):
    """The plans of all tables that the operators store."""
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    found = []

    def noting(module):
        real = module.store

        def store(df, name, **options):
            found.append(df._jdf.queryExecution().executedPlan().toString())
            return real(df, name, **options)

        monkeypatch.setattr(module, "store", store)

    for module in (components, simhash, templates):
        noting(module)
    return found


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_of_fingerprints(spark):
    pairs = simhash.near_fingerprints(spark.range(1000).selectExpr("xxhash64(id) AS fp"))
    assert "Broadcast" not in plan(pairs) and "SortMergeJoin" in plan(pairs)


def test_near_copies(spark, folder, plans):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plans += [plan(simhash.simhash_groups(docs)), plan(simhash.drop_near_copies(docs))]
    assert sum("SortMergeJoin" in p for p in plans) >= 6
    assert not any("Broadcast" in p for p in plans)


def test_lines(spark, folder, plans):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plans.append(plan(templates.drop_repeated_lines(docs)))
    assert sum("SortMergeJoin" in p for p in plans) >= 4
    assert not any("Broadcast" in p for p in plans)
