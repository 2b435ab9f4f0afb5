"""Every query with SQL gives the same rows in Spark and in DuckDB."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_queries import normal

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(SQL))
def test_same_answer(spark, folder, duck, name):
    mine = entry.queries()[name](spark, folder).toPandas()
    theirs = duck.sql(SQL[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert normal(mine).equals(normal(theirs))
