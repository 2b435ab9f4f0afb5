from ringwatch.schema import CALL_COLUMNS
import pytest

from ringwatch.sources.calls import corrupt_records, load_calls, read_calls, with_parsed_time, write_calls


def test_csv_round_trip_keeps_types_and_nulls(spark, raw, tmp_path):
    path = str(tmp_path / "csv")
    write_calls(raw, path, "csv")
    back = read_calls(spark, path, "csv")
    assert back.columns == CALL_COLUMNS
    # Empty text and a missing one are the same in CSV.
    wanted = raw.na.replace("", None, subset=["complaint_text"])
    assert back.exceptAll(wanted).count() == 0 and wanted.exceptAll(back).count() == 0
    assert back.first()["caller_number"].startswith("+372")


def test_quotes_and_commas(spark, calls, tmp_path):
    path = str(tmp_path / "csv")
    df = calls({c: None for c in CALL_COLUMNS if c != "complaint_text"} | {"complaint_text": 'Ta ütles: "kaart, palun"'})
    write_calls(df.select(*CALL_COLUMNS), path, "csv")
    assert read_calls(spark, path).first()["complaint_text"] == 'Ta ütles: "kaart, palun"'


def test_missing_numbers_in_csv(spark, tmp_path):
    path = tmp_path / "calls.csv"
    row = ["c1", "+372500", "+372501", "1779624000", "NaN", "True", "", "False", *["False"] * 5, "", "", "3.0", "Unknown", "0.5"]
    path.write_text(",".join(CALL_COLUMNS) + "\n" + ",".join(row) + "\n")
    got = read_calls(spark, str(path)).first()
    assert got["caller_number"] == "+372500" and got["was_answered"] is True and got["manual_severity"] == 3.0
    assert [got[c] for c in ("duration_sec", "channel", "time_to_next_action_min", "complaint_text")] == [None] * 4


def test_date_layout_prunes_files(spark, raw, tmp_path):
    path = str(tmp_path / "by-date")
    timed = with_parsed_time(raw)
    write_calls(timed, path, by_date=True)
    day = spark.read.parquet(path).filter("call_date = date '2024-01-10'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(call_date" in plan
    assert day.count() == timed.filter("to_date(ts) = date '2024-01-10'").count() > 0


def test_loaded_numbers_are_digits(raw):
    assert load_calls(raw).filter("caller_number rlike '[^0-9]' or called_number rlike '[^0-9]'").count() == 0


def test_column_pruning_reaches_the_events(spark):
    from ringwatch.sources.event_calls import read_event_calls

    # Not the folder whose calls the session has cached.
    plan = read_event_calls(spark, "/root/testdata/sf0.01").groupBy("channel").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint>" in plan


GOOD = ["c1", "+372500", "+372501", "1779624000", "10", "True", "", "False", *["False"] * 5, "", "", "3.0", "Unknown", "0.5"]


def csv_of(tmp_path, *records):
    path = tmp_path / "calls.csv"
    path.write_text(",".join(CALL_COLUMNS) + "\n" + "".join(record + "\n" for record in records))
    return str(path)


def test_damaged_csv_fails_and_is_shown(spark, tmp_path):
    odd = [*GOOD[:4], "ten", *GOOD[5:]]
    path = csv_of(tmp_path, ",".join(GOOD), ",".join(odd), ",".join(GOOD[:9]))
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        read_calls(spark, path).select("call_id").collect()
    assert sorted(r[0] for r in corrupt_records(spark, path).collect()) == sorted([",".join(odd), ",".join(GOOD[:9])])
    assert corrupt_records(spark, csv_of(tmp_path, ",".join(GOOD))).count() == 0


def test_line_breaks_in_quotes_need_multi_line(spark, tmp_path):
    text = [*GOOD]
    text[CALL_COLUMNS.index("complaint_text")] = '"first\nsecond"'
    path = csv_of(tmp_path, ",".join(text))
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        read_calls(spark, path).collect()
    assert corrupt_records(spark, path).count() == 2
    assert [r["complaint_text"] for r in read_calls(spark, path, multi_line=True).collect()] == ["first\nsecond"]
