from __future__ import annotations

from datetime import date, datetime

import pytest

from cellpulse.operators import aggregate, clean
from cellpulse.schemas import MEASURES, RAW_SCHEMA, SOURCE_COLUMN

TIME = "2013-11-01 05:00:00"
CASES = {
    "normal": (TIME, "1", "39", "1", "2", "3", "4", "5"),
    "empty measure": (TIME, "2", "39", None, "2", "3", "4", "5"),
    "non-numeric": (TIME, "3", "39", "abc", "2", "3", "4", "5"),
    "zero activity": (TIME, "4", "39", None, None, None, None, None),
    "negative": (TIME, "5", "39", "1", "2", "3", "-1", "5"),
    "no cell": (TIME, None, "39", "1", "2", "3", "4", "5"),
    "bad time": ("bad", "7", "39", "1", "2", "3", "4", "5"),
    "two faults": (TIME, None, "39", "1", "2", "3", "-1", "5"),
    "null in a rejected row": ("bad", "9", "39", None, "2", "3", "4", "5"),
    "NaN text": (TIME, "10", "39", "1", "2", "3", "4", "NaN"),
    "first country": (TIME, "11", "39", "1", "2", "3", "4", "5"),
    "second country": (TIME, "11", "33", "10", "20", "30", "40", "50"),
}


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(list(CASES.values()), RAW_SCHEMA)


def test_valid_rows(raw):
    rows = {r["grid_id"]: r for r in clean.clean_activity(raw).where("country_code = '39'").collect()}
    assert sorted(rows) == ["1", "10", "11", "2", "3", "4"]
    normal = rows["1"]
    assert (normal["total_sms"], normal["total_calls"], normal["total_activity"]) == (3.0, 7.0, 15.0)
    assert normal["timestamp"] == datetime(2013, 11, 1, 5)
    assert (normal["date"], normal["hour"], normal["day_of_week"]) == (date(2013, 11, 1), 5, 6)
    assert rows["2"]["sms_in"] == 0.0 and rows["3"]["sms_in"] == 0.0
    assert rows["10"]["internet_activity"] == 0.0 and rows["10"]["total_activity"] == 10.0
    assert all(rows["4"][m] == 0.0 for m in MEASURES)


def test_rejected_rows_have_all_reasons(raw):
    rows = clean.rejected_rows(raw).collect()
    found = {(r["CellID"], r["callout"], r["datetime"]): r["reasons"] for r in rows}
    assert found == {
        ("5", "-1", TIME): ["negative call_out"],
        (None, "4", TIME): ["missing grid_id"],
        ("7", "4", "bad"): ["invalid timestamp"],
        (None, "-1", TIME): ["missing grid_id", "negative call_out"],
        ("9", "4", "bad"): ["invalid timestamp"],
    }


def test_null_profile_counts_before_rejection(raw):
    row = clean.null_profile(raw).first()
    assert row["row_count"] == len(CASES)
    assert row["sms_in_nulls"] == 4  # empty, abc, zero activity, and the rejected row
    assert row["internet_activity_nulls"] == 2
    assert row["activity_nulls_handled"] == 9
    assert row["valid_row_nulls"] == 8
    assert row["cast_failures"] == 2


def test_metrics_add_up(raw):
    m = clean.run_metrics(raw).first()
    assert (m["input_rows"], m["rejected_rows"], m["cleaned_rows"], m["output_rows"]) == (12, 5, 7, 6)
    assert m["activity_nulls_handled"] == 9


def test_empty_input(spark):
    empty = spark.createDataFrame([], RAW_SCHEMA)
    assert clean.run_metrics(empty).first().asDict() == {
        "input_rows": 0,
        "rejected_rows": 0,
        "cleaned_rows": 0,
        "activity_nulls_handled": 0,
        "output_rows": 0,
    }
    assert clean.null_profile(empty).first()["activity_nulls_handled"] == 0


def test_checked_rows_keep_every_row(raw):
    from pyspark.sql import functions as F

    checked = clean.checked_rows(raw.withColumn(SOURCE_COLUMN, F.lit("/x/sms-call-internet-mi-2013-11-01.csv")))
    assert checked.count() == len(CASES)
    bad = checked.where("row_status = 'REJECTED'").collect()
    assert len(bad) == 5 and all(r["raw_record"]["countrycode"] == "39" for r in bad)
    assert all(r["date"] == date(2013, 11, 1) for r in bad)
    good = checked.where("row_status = 'VALID'")
    assert good.where("reasons is not null or raw_record is not null").count() == 0


def test_missing_column_is_named(raw):
    with pytest.raises(ValueError, match="call_in"):
        clean.clean_activity(raw.drop("callin"))
    # The country code is not needed.
    assert clean.clean_activity(raw.drop("countrycode")).count() == 7


def test_extra_columns_pass_through(raw):
    from pyspark.sql import functions as F

    assert "note" in clean.clean_activity(raw.withColumn("note", F.lit("x"))).columns


def test_explicit_formats(raw, spark):
    rows = spark.createDataFrame([("01/11/2013 05:00", "1", "39", "1", "2", "3", "4", "5")], RAW_SCHEMA)
    assert clean.clean_activity(rows).count() == 0
    found = clean.clean_activity(rows, ["yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm"]).first()
    assert found["timestamp"] == datetime(2013, 11, 1, 5)


def test_countries_collapse(raw):
    hourly = aggregate.hourly_grid_summary(clean.clean_activity(raw))
    row = hourly.where("grid_id = '11'").collect()
    assert len(row) == 1
    assert row[0]["total_activity"] == 165.0
    assert row[0]["internet_share"] == pytest.approx(55 / 165)
    assert hourly.where("grid_id = '4'").first()["internet_share"] == 0.0


def test_rollups(raw):
    hourly = aggregate.hourly_grid_summary(clean.clean_activity(raw))
    dashboard = aggregate.dashboard_summary(hourly).collect()
    assert len(dashboard) == 1 and dashboard[0]["active_grid_count"] == 6
    top = aggregate.top_grids(hourly, 2).collect()
    assert [r["grid_id"] for r in top] == ["11", "1"]
    assert aggregate.peak_hour(hourly).first()["timestamp"] == datetime(2013, 11, 1, 5)
    daily = aggregate.daily_grid_summary(hourly).where("grid_id = '1'").first()
    assert daily["daily_avg_activity"] == daily["daily_max_activity"] == 15.0
