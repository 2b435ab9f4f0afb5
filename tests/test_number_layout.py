import pytest
from pyspark.sql import functions as F

from ringwatch.operators.lookup import matching_calls
from ringwatch.operators.ordered import exact_medians, median_sketches, sketched_medians
from ringwatch.sources.calls import load_calls, replace_days, with_parsed_time, write_calls
from ringwatch.sources.number_layout import files_of, stored_matches, write_by_number


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Calls of 400 numbers and of one that makes a third of all, in 32 files."""
    path = str(tmp_path_factory.mktemp("layout"))
    number = F.when(F.col("id") % 3 == 0, "37260000").otherwise((F.lit(37250000) + F.col("id") % 400).cast("string"))
    calls = spark.range(6000).select(
        F.format_string("c%05d", "id").alias("call_id"),
        F.when(F.col("id") % 97 != 0, number).alias("caller_number"),
        F.lit(0.5).alias("confidence_score"),
    )
    calls = calls.cache()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    write_by_number(calls, path)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    return calls, path


@pytest.mark.parametrize("number", ["37250123", "3725012", "37260000", "+372 5001", "9", "", None, "372500001"])
def test_same_rows_as_a_scan(spark, stored, number):
    calls, path = stored
    found, wanted = stored_matches(spark, path, number), matching_calls(calls, number)
    assert found.columns == wanted.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_few_files_are_read(spark, stored):
    _, path = stored
    n = spark.read.parquet(f"{path}/ranges").count()
    assert n >= 24
    assert len(files_of(spark, path, "37250123")) <= 2
    found = stored_matches(spark, path, "37250123")
    assert len(found.inputFiles()) <= 2
    assert "StartsWith(caller_number,37250123)" in found._jdf.queryExecution().executedPlan().toString()
    # The busy number is cut over several files.
    assert 4 <= len(files_of(spark, path, "37260000")) < n


def test_empty_layout(spark, stored, tmp_path):
    calls, _ = stored
    write_by_number(calls.limit(0), str(tmp_path))
    assert stored_matches(spark, str(tmp_path), "372").count() == 0


def test_other_days_keep_their_files(spark, raw, tmp_path):
    path = str(tmp_path / "by-date")
    timed = with_parsed_time(raw)
    write_calls(timed, path, by_date=True)
    before = set(spark.read.parquet(path).inputFiles())
    day = timed.filter("to_date(ts) = date '2024-01-10'")
    replace_days(day.limit(1), path)
    table = spark.read.parquet(path)
    after = set(table.inputFiles())
    assert table.filter("call_date = date '2024-01-10'").count() == 1 < day.count()
    assert all("call_date=2024-01-10" in f for f in before ^ after) and before - after and after - before
    assert table.count() == timed.count() - day.count() + 1
    replace_days(day.limit(0), path)
    assert set(spark.read.parquet(path).inputFiles()) == after


def test_sketches_of_days_merge_to_a_median(spark):
    n = 60_000
    # One group has a third of its rows at one value; one value is missing, one is no number.
    rows = spark.range(n).select(
        (F.col("id") % 30).alias("day"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(10_000)).cast("double")).alias("x"),
        F.when(F.col("id") == 7, None).when(F.col("id") == 8, float("nan")).otherwise(F.col("id").cast("double")).alias("y"),
    )
    daily = median_sketches(rows, ["x", "y"], ["day"])
    assert daily.count() == 60
    found = {r["column"]: r for r in sketched_medians(daily).collect()}
    assert found["x"]["n"] == n and found["y"]["n"] == n - 2
    for c in ("x", "y"):
        share = rows.filter(~F.isnan(c)).agg(F.avg((F.col(c) <= found[c]["median"]).cast("int"))).first()[0]
        assert abs(share - 0.5) < 0.01
    small = spark.createDataFrame([(1.0,), (3.0,), (2.0,)], "x double")
    assert sketched_medians(median_sketches(small, ["x"])).first()["median"] == exact_medians(small, ["x"]).first()["median"]
    assert sketched_medians(median_sketches(small.limit(0), ["x"])).count() == 0
