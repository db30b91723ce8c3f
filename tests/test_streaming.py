from __future__ import annotations

from datetime import date

import pytest
from data import HEADER, day_lines, write_day
from pyspark.sql import functions as F

from cellpulse.operators import aggregate, clean
from cellpulse.session import stored
from cellpulse.sources import landing
from cellpulse.streaming import dedup, incremental

DAYS = ("2013-11-01", "2013-11-02", "2013-11-03")


def put(folder, day, **options):
    return write_day(folder, day, day_lines(day, **options))


def test_only_new_files_are_read(spark, tmp_path):
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        incremental.copy_new_rows(incremental.stream_raw(spark, str(inbox)), out, state)
        return spark.read.parquet(out).count()

    put(inbox, DAYS[0])
    assert run() == 24
    put(inbox, DAYS[1])
    assert run() == 48
    assert run() == 48


def test_sums_equal_the_batch_result(spark, tmp_path):
    """Days in wrong order, one file at a time, in two runs: nothing is too late."""
    inbox, sums, state = tmp_path / "in", str(tmp_path / "sums"), str(tmp_path / "state")
    put(inbox, DAYS[2])
    write_day(inbox, "2013-10-01", day_lines("2013-10-01"))
    incremental.hourly_from_landing(spark, str(inbox), sums, state, max_files=1)
    for day in DAYS[:2]:
        put(inbox, day, values="0.1,0.2,,x,5")
    wanted = aggregate.hourly_grid_summary(clean.clean_activity(landing.read_raw(spark, str(inbox))))
    wanted = stored(wanted, "wanted")
    # The same hours and cell again, under another name: they add nothing.
    write_day(inbox, "extra", day_lines(DAYS[2], hours=2), name="sms-call-internet-mi-extra.csv")
    found = incremental.hourly_from_landing(spark, str(inbox), sums, state, max_files=1)
    rounded = lambda df: df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    assert found.count() == wanted.count() == 96
    assert rounded(found).exceptAll(rounded(wanted)).count() == 0
    again = incremental.hourly_from_landing(spark, str(inbox), sums, state)
    assert rounded(again).exceptAll(rounded(wanted)).count() == 0
    assert incremental.read_hourly_sums(spark, f"{sums}/sums", [date(2013, 11, 1)]).count() == 24
    assert incremental.compact_sums(spark, f"{sums}/sums") is not None
    put(inbox, "2013-11-04")
    later = incremental.hourly_from_landing(spark, str(inbox), sums, state)
    assert rounded(later.where("date < '2013-11-04'")).exceptAll(rounded(wanted)).count() == 0
    assert later.count() == 120


def test_repeated_delivery_counts_once(spark, tmp_path):
    """Also when it comes in a later run, behind newer days, and when one row fills half a file."""
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        rows = clean.clean_activity(incremental.stream_raw(spark, str(inbox), max_files=1))
        incremental.append_first_deliveries(rows, out, state)
        return spark.read.parquet(out).count()

    put(inbox, DAYS[0])
    assert run() == 24
    put(inbox, DAYS[2])
    write_day(inbox, DAYS[1], day_lines(DAYS[1]) + [day_lines(DAYS[1])[4]] * 30 + [f"{DAYS[1]} 04:00:00,1,,1,1,1,1,1"])
    assert run() == 24 + 24 + 25
    write_day(inbox, DAYS[0], day_lines(DAYS[0]), name="sms-call-internet-mi-again.csv")
    write_day(inbox, DAYS[1], [f"{DAYS[1]} 04:00:00,1,,1,1,1,1,1"], name="sms-call-internet-mi-more.csv")
    assert run() == 73
    assert run() == 73


def test_windowed_totals_close_after_the_delay(spark, tmp_path):
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        rows = clean.clean_activity(incremental.stream_raw(spark, str(inbox)))
        totals = incremental.windowed_totals(rows, "1 day")
        incremental.copy_new_rows(totals, out, state)
        return spark.read.parquet(out)

    for day in DAYS:
        put(inbox, day)
        found = run()
    closed = found.where("timestamp < '2013-11-02'")
    assert closed.count() == 24 and closed.agg(F.sum("sms_in")).first()[0] == 24.0


def test_other_column_order_fails_instead_of_being_misread(spark, tmp_path):
    inbox = tmp_path / "in"
    header = ",".join(reversed(HEADER.split(",")))
    write_day(inbox, DAYS[0], [",".join(reversed(x.split(","))) for x in day_lines(DAYS[0])], header)
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        incremental.copy_new_rows(
            incremental.stream_raw(spark, str(inbox)), str(tmp_path / "out"), str(tmp_path / "state")
        )


def test_deduplication_state_is_bounded_and_survives_a_restart(spark, tmp_path):
    """A day sent again within the delay is recognised, an older one is too late; old keys leave the state."""
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        rows = clean.clean_activity(incremental.stream_raw(spark, str(inbox), max_files=1))
        return dedup.append_unique(rows, out, state, "1 day")

    stored = lambda: spark.read.parquet(out).count()
    put(inbox, DAYS[0])
    run()
    assert stored() == 24
    put(inbox, DAYS[1])
    write_day(inbox, "again-1", day_lines(DAYS[1]), name="sms-call-internet-mi-again-1.csv")
    run()
    assert stored() == 48
    put(inbox, DAYS[2])
    for n, day in (("4", "2013-11-04"), ("5", "2013-11-05")):
        put(inbox, day)
        run()
    write_day(inbox, "again-2", day_lines(DAYS[0]), name="sms-call-internet-mi-again-2.csv")
    last = run()
    assert stored() == 120
    assert sum(b["too_late"] for b in last) == 24
    assert last[-1]["state_rows"] <= 48
    assert run() == [] or stored() == 120
    wanted = aggregate.hourly_grid_summary(clean.clean_activity(landing.read_raw(spark, str(inbox)).where("_source_file not like '%again%'")))
    assert wanted.count() == 120
