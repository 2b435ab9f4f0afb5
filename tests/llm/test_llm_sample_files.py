"""The bounded samples of the classifiers are written as a few files, whatever the number of shuffle partitions."""

import pytest

from ringwatch.llm import ftrl, toxicity


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_samples_are_few_files(spark, many_partitions, monkeypatch):
    docs = spark.createDataFrame([(k, f"word{k % 7} good" if k % 2 else f"word{k % 5} bad") for k in range(300)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id AS id", "cast(doc_id % 2 AS int) AS label", "cast(doc_id % 3 = 0 AS int) AS other")
    parts = []

    def counted(real):
        def store(df, name, **options):
            found = real(df, name, **options)
            if name.endswith("sample"):
                parts.append(len(found.inputFiles()))
            return found

        return store

    for module in (ftrl, toxicity):
        monkeypatch.setattr(module, "store", counted(module.store))
    assert ftrl.score_logistic(docs, labels.select("id", "label")).count() == 300
    assert toxicity.score_chain(docs, labels, ["label", "other"]).count() == 300
    assert len(parts) == 3 and max(parts) <= ftrl.SAMPLE_TASKS
