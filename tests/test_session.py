"""Stored stages belong to a job and go with it."""

from pathlib import Path

import pytest

from ringwatch.session import checkpoint_root, freeze, job, store


def files(folder):
    return [p for p in Path(folder.removeprefix("file:")).rglob("*") if p.is_file()]


def test_a_job_leaves_nothing(spark):
    with job(spark) as folder:
        stored = store(spark.range(5), "numbers")
        assert stored.count() == 5 and freeze(spark.range(3)).count() == 3
        assert checkpoint_root(spark) == folder and files(folder)
    assert not Path(folder.removeprefix("file:")).exists()
    assert checkpoint_root(spark) != folder


def test_a_failed_job_leaves_nothing(spark):
    with pytest.raises(RuntimeError, match="half way"):
        with job(spark) as folder:
            store(spark.range(5), "numbers")
            raise RuntimeError("half way")
    assert not Path(folder.removeprefix("file:")).exists()


def test_outside_a_job_tables_stay(spark):
    before = store(spark.range(4), "numbers")
    with job(spark):
        store(spark.range(5), "numbers")
    assert before.count() == 4
