from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from data import day_lines, feature, square, write_day, write_geojson
from pyspark.sql import functions as F

from cellpulse.operators import gate2
from cellpulse.plans import batch, ingest, publish, score

AT = datetime(2024, 1, 1)


@pytest.fixture
def zones(tmp_path):
    for day in ("2013-11-01", "2013-11-02", "2013-11-03"):
        lines = day_lines(day) + day_lines(day, values="10,,x,0,1", cell="2")
        lines.append(f"{day} 03:00:00,1,33,5,5,5,5,{500 if day.endswith('02') else 5}")
        write_day(tmp_path / "in", day, lines)
    write_day(tmp_path / "in", "2013-11-04", [*day_lines("2013-11-04"), "bad,1,39,1,2,3,4,5"])
    reference = write_geojson(tmp_path / "ref" / "grid.geojson", [feature(1, square(0, 0)), feature(3, square(1, 1))])
    return str(tmp_path / "in"), str(tmp_path / "out"), reference


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_run_publishes_everything(spark, zones):
    source, out, reference = zones
    result = batch.run_batch(spark, source, out, reference, "r1", AT)
    m = result.metrics
    assert (m["input_rows"], m["rejected_rows"], m["cleaned_rows"]) == (172, 1, 171)
    assert m["activity_nulls_handled"] == 2 * 72
    assert m["output_rows"] == 24 * 7 and m["lookup_rows"] == 2
    assert (m["activity_grids"], m["missing_geometry_grids"], m["coverage_percentage"]) == (2, 1, 50.0)
    assert m["peak_hour"] == datetime(2013, 11, 2, 3)
    assert all(r["passed"] for r in result.checks)

    assert batch.read_clean(spark, out).count() == 171
    rejected = batch.read_rejected(spark, out).collect()
    assert [(r["datetime"], r["reasons"]) for r in rejected] == [("bad", ["invalid timestamp"])]
    hourly = publish.read_published(spark, out, "hourly_grid_summary")
    assert hourly.count() == 168 and dict(hourly.dtypes)["date"] == "date"
    assert publish.read_published(spark, out, "daily_traffic_summary").count() == 7
    assert publish.read_published(spark, out, "hotspots").count() == 168
    csv = spark.read.option("header", True).csv(result.outputs["dashboard_summary"])
    times = [r["timestamp"] for r in csv.collect()]
    assert len(times) == 96 and times == sorted(times)
    top = spark.read.parquet(result.outputs["top_grids_geo"]).collect()
    assert {r["grid_id"]: r["geometry"] is not None for r in top} == {"1": True, "2": False}

    publish.register_views(spark, out, ["hourly_grid_summary"])
    assert spark.sql("select count(*) from hourly_grid_summary").first()[0] == 168


def test_rerun_gives_the_same_and_replaces(spark, zones):
    source, out, reference = zones
    batch.run_batch(spark, source, out, reference, "r1", AT)
    tables = ("hourly_grid_summary", "activity_alerts", "daily_grid_summary")
    keep = lambda t: publish.read_published(spark, out, t).drop("run_id", "created_at")
    before = {t: rows_of(keep(t)) for t in tables}
    batch.run_batch(spark, source, out, reference, "r2", AT + timedelta(days=1))
    assert {t: rows_of(keep(t)) for t in tables} == before
    runs = publish.read_published(spark, out, "hourly_grid_summary").select("run_id").distinct().collect()
    assert [r["run_id"] for r in runs] == ["r2"]


def test_a_later_day_replaces_only_itself(spark, zones, tmp_path):
    source, out, reference = zones
    batch.run_batch(spark, source, out, reference, "r1", AT)
    write_day(tmp_path / "again", "2013-11-02", day_lines("2013-11-02", values="0,0,0,0,1"))
    options = {"history_days": 9, "min_computable": 0.0}
    batch.run_batch(spark, str(tmp_path / "again"), out, reference, "r2", AT + timedelta(days=1), **options)
    hourly = publish.read_published(spark, out, "hourly_grid_summary")
    counts = {r["date"]: (r["run_id"], r["count"]) for r in hourly.groupBy("date", "run_id").count().collect()}
    assert counts[date(2013, 11, 2)] == ("r2", 24)
    assert counts[date(2013, 11, 1)] == ("r1", 48)


def test_rows_that_vanish_do_not_stay_published(spark, zones, tmp_path):
    """A date with alerts before and none now shows none."""
    source, out, reference = zones
    batch.run_batch(spark, source, out, reference, "r1", AT)
    alerts = publish.read_published(spark, out, "activity_alerts")
    assert alerts.select("grid_id", "timestamp").collect() == [("1", datetime(2013, 11, 2, 3))]
    days = [str(r["date"]) for r in alerts.select("date").distinct().collect()]
    for day in days:
        write_day(tmp_path / "quiet", day, day_lines(day))
    options = {"history_days": 9, "min_computable": 0.0}
    batch.run_batch(spark, str(tmp_path / "quiet"), out, reference, "r2", AT + timedelta(days=1), **options)
    assert publish.read_published(spark, out, "activity_alerts").count() == 0
    with pytest.raises(LookupError):
        publish.read_published(spark, out, "other")


def test_failing_check_leaves_published_data_untouched(spark, zones, tmp_path):
    source, out, reference = zones
    batch.run_batch(spark, source, out, reference, "r1", AT)
    before = rows_of(publish.read_published(spark, out, "hourly_grid_summary"))
    write_day(tmp_path / "part", "2013-11-02", day_lines("2013-11-02", hours=5))
    for run in ("r2", "r1"):  # also when the id of the published run comes again
        with pytest.raises(publish.PublicationRefused) as refused:
            batch.run_batch(
                spark, str(tmp_path / "part"), out, reference, run, AT + timedelta(days=1), min_computable=0.0
            )
        assert refused.value.failed == ["hourly_intervals_present"]
    assert rows_of(publish.read_published(spark, out, "hourly_grid_summary")) == before


def test_stray_rows_of_another_date_stop_the_run(spark, zones, tmp_path):
    source, out, reference = zones
    batch.run_batch(spark, source, out, reference, "r1", AT)
    lines = [*day_lines("2013-11-05"), *day_lines("2013-11-04")]
    write_day(tmp_path / "late", "2013-11-05", lines)
    with pytest.raises(publish.PublicationRefused) as refused:
        batch.run_batch(
            spark, str(tmp_path / "late"), out, reference, "r2", AT + timedelta(days=1), min_computable=0.0
        )
    assert refused.value.failed == ["rows_of_delivered_dates"]


def test_missing_date_is_found(spark, zones):
    source, out, reference = zones
    with pytest.raises(publish.PublicationRefused) as refused:
        batch.run_batch(spark, source, out, reference, "r1", AT, start=date(2013, 10, 31), end=date(2013, 11, 4))
    assert "expected_dates_present" in refused.value.failed


def test_gate_comes_first(spark, zones, tmp_path):
    """The file gate keeps the malformed day out of the pipeline."""
    source, out, reference = zones
    result = batch.run_landing(spark, source, out, reference, "r1", AT)
    assert result.metrics["input_rows"] == 147 and result.metrics["rejected_rows"] == 0
    dates = publish.read_published(spark, out, "hourly_grid_summary").select("date").distinct()
    assert dates.count() == 3


def test_missing_inputs(spark, zones, tmp_path):
    source, out, reference = zones
    with pytest.raises(FileNotFoundError):
        batch.run_batch(spark, str(tmp_path / "none"), out, reference, "r", AT)
    with pytest.raises(FileNotFoundError):
        batch.run_batch(spark, source, out, str(tmp_path / "none.geojson"), "r", AT)


def hourly_rows(spark, rows):
    names = "timestamp timestamp, grid_id string, sms_in double, sms_out double, call_in double, call_out double, internet_activity double"
    return spark.createDataFrame(rows, names)


def test_hourly_checks_find_each_fault(spark):
    start = datetime(2024, 1, 1)
    good = [(start + timedelta(hours=h), "1", 1.0, 1.0, 1.0, 1.0, 1.0) for h in range(24)]

    def failed(rows, **options):
        checks = gate2.hourly_checks(hourly_rows(spark, rows), **options).collect()
        return [c["check_name"] for c in checks if not c["passed"]]

    assert failed(good) == []
    assert failed(good[:-1]) == ["hourly_intervals_present"]
    assert failed([*good, good[0]]) == ["unique_grid_timestamp"]
    assert failed([*good, (start, "x1", 1.0, 1.0, 1.0, 1.0, 1.0)]) == ["grid_id_valid"]
    assert failed([*good, (start, "2", -1.0, 1.0, 1.0, 1.0, 1.0)]) == ["no_negative_measures"]
    assert failed([*good, (start, "2", None, 1.0, 1.0, 1.0, 1.0)]) == ["no_null_measures"]
    assert failed([*good, (start, "2", float("nan"), 1.0, 1.0, 1.0, 1.0)]) == ["measures_numeric"]
    assert failed([*good, (None, "2", 1.0, 1.0, 1.0, 1.0, 1.0)]) == ["timestamps_valid"]
    assert "expected_dates_present" in failed(good, start=date(2024, 1, 1), end=date(2024, 1, 2))


def test_reconcile_finds_a_lost_row(spark):
    start = datetime(2024, 1, 1)
    rows = hourly_rows(spark, [(start, str(i), 1.0, 2.0, 0.0, 0.0, 0.5) for i in range(5)])
    assert gate2.reconcile_check(gate2.reconcile(rows, rows)).first()["passed"]
    lost = rows.where("grid_id <> '3'")
    compared = gate2.reconcile(rows, lost)
    assert not gate2.reconcile_check(compared).first()["passed"]
    assert {r["measure"] for r in compared.where(~F.col("passed")).collect()} == {"sms_in", "sms_out", "internet_activity"}


def test_dashboard_in_several_files_is_split_by_time(spark, tmp_path):
    rows = [(datetime(2024, 1, 1) + timedelta(hours=h), 1.0) for h in range(100)]
    df = spark.createDataFrame(rows, "timestamp timestamp, total_activity double")
    publish.write_dashboard_csv(df, str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    publish.write_dashboard_csv(df, str(tmp_path / "many"), files=4)
    files = sorted((tmp_path / "many").glob("*.csv"))
    assert len(files) > 1
    times = [line.split(",")[0] for f in files for line in f.read_text().splitlines()[1:]]
    assert len(times) == 100 and times == sorted(times)


def test_single_days_use_published_history(spark, tmp_path):
    reference = write_geojson(tmp_path / "g.geojson", [feature(1, square(0, 0))])
    out = str(tmp_path / "out")
    for n, day in enumerate(("2013-11-01", "2013-11-02", "2013-11-03")):
        values = "10,10,10,10,10" if n == 2 else "1,1,1,1,1"
        write_day(tmp_path / day, day, day_lines(day, values=values))
        at = AT + timedelta(days=n)
        # The first day has no other one to compare with.
        options = {"history_days": 7, "min_computable": 0.0 if n == 0 else 50.0}
        batch.run_batch(spark, str(tmp_path / day), out, reference, f"r{n}", at, **options)
    spots = publish.read_published(spark, out, "hotspots")
    third = spots.where("date = '2013-11-03'").collect()
    assert {(r["baseline_activity"], r["activity_ratio"], r["hotspot_flag"]) for r in third} == {(5.0, 10.0, True)}
    assert {r["baseline_activity"] for r in spots.where("date = '2013-11-01'").collect()} == {None}
    assert publish.read_published(spark, out, "activity_alerts").count() == 24
    # The same day again: its own earlier rows are no history.
    batch.run_batch(spark, str(tmp_path / "2013-11-03"), out, reference, "r9", AT + timedelta(days=9), history_days=7)
    assert publish.read_published(spark, out, "hotspots").where("date = '2013-11-03' and baseline_activity = 5").count() == 24


def test_risk_scores_are_published(spark, zones):
    source, out, reference = zones
    batch.run_batch(spark, source, out, reference, "r1", AT)
    score.run_risk(spark, out, "s1", AT)
    found = publish.read_published(spark, out, "risk_scores")
    assert found.count() == 2 * 4 * 24
    assert found.where("risk_score < 0 or risk_score > 1 or risk_score is null").count() == 0


def test_limits_of_checks_hold_by_default(spark, zones, tmp_path):
    """A single day without history has no baseline; cells that the reference lacks are too many."""
    source, out, reference = zones
    write_day(tmp_path / "one", "2013-11-02", day_lines("2013-11-02"))
    with pytest.raises(publish.PublicationRefused) as refused:
        batch.run_batch(spark, str(tmp_path / "one"), out, reference, "r1", AT)
    assert refused.value.failed == ["baselines_computable"]
    other = write_geojson(tmp_path / "other.geojson", [feature(77, square(0, 0))])
    with pytest.raises(publish.PublicationRefused) as refused:
        batch.run_batch(spark, source, out, other, "r1", AT)
    assert refused.value.failed == ["grids_in_reference", "grids_represented"]


def test_hours_count_inside_the_range_only(spark):
    start = datetime(2024, 1, 1)
    hours = [*range(24), *range(24, 36), *range(48, 72)]
    rows = [(start + timedelta(hours=h), "1", 1.0, 1.0, 1.0, 1.0, 1.0) for h in hours]
    checks = gate2.hourly_checks(hourly_rows(spark, rows), date(2024, 1, 1), date(2024, 1, 2)).collect()
    found = {c["check_name"]: (c["passed"], c["observed"]) for c in checks}
    assert found["hourly_intervals_present"] == (False, 36.0)


def test_a_part_that_comes_late_belongs_to_the_next_run(spark, zones, tmp_path, monkeypatch):
    source, out, reference = zones
    judge = ingest.judge_landing

    def judge_then_deliver(*args, **options):
        found = judge(*args, **options)
        write_day(tmp_path / "in", "2013-11-09", day_lines("2013-11-09", values="-1,1,1,1,1"))
        return found

    monkeypatch.setattr(ingest, "judge_landing", judge_then_deliver)
    routed = ingest.ingest(spark, source, out, "r1", AT)
    assert routed.where("filename like '%11-09%'").count() == 0
    assert ingest.read_log(spark, out).where("filename like '%11-09%'").count() == 0
    monkeypatch.undo()
    again = ingest.ingest(spark, source, out, "r2", AT)
    assert [r["status"] for r in again.where("filename like '%11-09%'").select("status").distinct().collect()] == ["REJECTED"]
