from __future__ import annotations

from datetime import date, datetime

import pytest
from data import HEADER, day_lines, write_day

from cellpulse.operators import gate1, reports
from cellpulse.plans import ingest
from cellpulse.sources import landing

DAY = "2013-11-01"


def replace_first(lines, new):
    return [new, *lines[1:]]


def judge(spark, folder, mode="strict", **options):
    found, _ = gate1.judge_landing(spark, str(folder), mode, **options)
    return {r["filename"].removeprefix("sms-call-internet-mi-").removesuffix(".csv"): r for r in found.collect()}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """One file per case; the case is told by the date."""
    root = tmp_path_factory.mktemp("landing")

    def put(n, lines=None, header=HEADER, name=None):
        day = f"2013-11-{n:02d}"
        write_day(root, day, day_lines(day) if lines is None else lines(day), header, name)

    put(1)
    put(2, lambda d: [line.rsplit(",", 1)[0] for line in day_lines(d)], HEADER.rsplit(",", 1)[0])
    put(
        3,
        lambda d: [f"9,{d} {h:02d}:00:00,1,39,x,2,3,4,5" for h in range(24)],
        "internet,datetime,CellID,countrycode,note,smsout,callin,callout,smsin",
    )
    put(4, lambda d: [])
    (root / "sms-call-internet-mi-2013-11-05.csv").write_text("")
    put(6, lambda d: replace_first(day_lines(d), "never,1,39,1,2,3,4,5"))
    put(7, lambda d: day_lines(d, hours=23))
    put(8, lambda d: replace_first(day_lines(d), f"{d} 00:00:00,1,39,-1,2,3,4,5"))
    put(9, lambda d: replace_first(day_lines(d), f"{d} 00:00:00,1,39,,-2,3,4,5"))
    put(10, lambda d: replace_first(day_lines(d), f"{d} 00:00:00,1,39,-1,,3,4,5"))
    put(11, lambda d: replace_first(day_lines(d), "11/11/2013 00:00,1,39,1,2,3,4,5"))
    put(12, lambda d: replace_first(day_lines(d), f"{d} 00:00:00,1,39,1,2,3,4,5,6"))
    put(13, lambda d: day_lines(d), name="sms-call-internet-mi-latest.csv")
    put(14, lambda d: day_lines("2013-11-15"))
    put(16, lambda d: [*day_lines(d), day_lines(d)[3]])
    put(17, lambda d: [HEADER, *day_lines(d)])
    put(18, lambda d: [line.replace(":00:00", ":30:00") for line in day_lines(d)])
    put(19, lambda d: replace_first(day_lines(d), f"{d} 00:00:00,1,39"))
    put(20, lambda d: replace_first(day_lines(d), f"{d} 00:00:00,1,39,NaN,NA,,4,5"))
    put(21, lambda d: [HEADER, *day_lines(d)], header="# exported")
    put(22, lambda d: [day_lines(d)[0], *day_lines(d)], header=None)
    (root / "grid.geojson").write_text("{}")
    return root


def test_detection(spark, folder):
    found = landing.detect_deliveries(spark, str(folder)).collect()
    names = [r["filename"] for r in found]
    assert names == sorted(names) and len(names) == 21
    assert next(r for r in found if r["filename"].endswith("-05.csv"))["bytes"] == 0


def test_missing_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        landing.freeze_listing(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        landing.read_raw(spark, str(tmp_path))


COMMON = {
    "2013-11-01": ("ACCEPTED", 24, "All validation checks passed"),
    "2013-11-02": ("REJECTED", 24, "Missing required column(s): internet"),
    "2013-11-03": ("ACCEPTED", 24, "All validation checks passed"),
    "2013-11-04": ("REJECTED", 0, "File contains zero rows"),
    "2013-11-05": ("REJECTED", 0, "Unable to read CSV: No columns to parse from file"),
    "2013-11-06": ("REJECTED", 24, "Malformed timestamp values: 1"),
    "2013-11-07": ("REJECTED", 23, "Expected exactly 24 distinct hourly timestamps, found 23"),
    "2013-11-08": ("REJECTED", 24, "Negative activity values found in smsin: 1"),
    "2013-11-10": ("REJECTED", 24, "Negative activity values found in smsin: 1"),
    "2013-11-11": ("REJECTED", 24, "Malformed timestamp values: 1"),
    "2013-11-12": ("REJECTED", 0, "Unable to read CSV: rows with too many fields: 1"),
    "2013-11-17": ("REJECTED", 25, "Malformed timestamp values: 1"),
    "2013-11-19": ("ACCEPTED", 24, "All validation checks passed"),
    "2013-11-20": ("ACCEPTED", 24, "All validation checks passed"),
}
REFERENCE = {
    "2013-11-09": ("ACCEPTED", 24, "All validation checks passed"),
    "latest": ("ACCEPTED", 24, "All validation checks passed"),
    "2013-11-14": ("ACCEPTED", 24, "All validation checks passed"),
    "2013-11-16": ("ACCEPTED", 25, "All validation checks passed"),
    "2013-11-18": ("ACCEPTED", 24, "All validation checks passed"),
}
STRICT = {
    "2013-11-09": ("REJECTED", 24, "Negative activity values found in smsout: 1"),
    "latest": ("REJECTED", 24, "File name does not carry a date"),
    "2013-11-14": ("REJECTED", 24, "Rows of another date than the file name: 24"),
    "2013-11-16": ("REJECTED", 25, "Duplicate source rows: 1"),
    "2013-11-18": ("REJECTED", 24, "Timestamps off the hour: 24"),
}


@pytest.mark.parametrize("mode,own", [("reference", REFERENCE), ("strict", STRICT)])
def test_verdicts(spark, folder, mode, own):
    rows = judge(spark, folder, mode)
    wanted = {**COMMON, **own}
    found = {k: (rows[k]["status"], rows[k]["row_count"], rows[k]["reason"]) for k in wanted}
    assert found == wanted
    # A first line that is no header: every required name is missing.
    assert rows["2013-11-21"]["status"] == rows["2013-11-22"]["status"] == "REJECTED"
    assert rows["2013-11-21"]["reason"].startswith(("Missing required", "Unable to read"))
    assert rows["2013-11-22"]["reason"].startswith("Missing required")


def test_all_reasons_and_warnings(spark, folder):
    rows = judge(spark, folder)
    assert rows["2013-11-20"]["warnings"] == [
        "Non-numeric values found in smsin: 1",
        "Non-numeric values found in smsout: 1",
        "Non-numeric values found in callin: 1",
    ]
    assert rows["2013-11-03"]["warnings"] == [
        "Extra column(s): note",
        "Columns are in another order",
    ]
    both = rows["2013-11-17"]["reasons"]
    assert both[0] == "Malformed timestamp values: 1"


def test_expected_hours_is_a_parameter(spark, tmp_path):
    write_day(tmp_path, DAY, day_lines(DAY, hours=23))
    assert judge(spark, tmp_path, expected_hours=23)[DAY]["status"] == "ACCEPTED"


def test_unknown_mode(spark, folder):
    with pytest.raises(ValueError):
        judge(spark, folder, "other")


def test_rows_are_aligned_by_name(spark, folder):
    rows = landing.read_raw(spark, str(folder)).where("_source_file like '%2013-11-03.csv'").collect()
    assert len(rows) == 24
    first = min(rows, key=lambda r: r["datetime"])
    assert first["datetime"] == "2013-11-03 00:00:00" and first["CellID"] == "1"
    assert (first["internet"], first["smsin"], first["smsout"]) == ("9", "5", "2")


def test_delivery_in_parts(spark, tmp_path):
    """A folder with the delivery's name counts as one delivery."""
    parts = tmp_path / f"sms-call-internet-mi-{DAY}.csv"
    lines = day_lines(DAY)
    write_day(parts, DAY, lines[:10], name="part-0.csv")
    write_day(parts, DAY, lines[10:], name="part-1.csv")
    row = judge(spark, tmp_path)[DAY]
    assert (row["status"], row["row_count"]) == ("ACCEPTED", 24)
    # The same row in both parts is a duplicate.
    write_day(parts, DAY, lines[9:], name="part-1.csv")
    assert judge(spark, tmp_path)[DAY]["reasons"] == ["Duplicate source rows: 1"]


def test_duplicates_against_a_count(spark):
    """A third of all rows are copies of one row; nulls are values of the key."""
    rows = [("a.csv", f"t{i % 700}", str(i % 3), None if i % 5 else "39") for i in range(2000)]
    rows += [("a.csv", "t0", "0", "39")] * 1000 + [("b.csv", "t0", "0", "39")]
    wanted = {}
    for name in ("a.csv", "b.csv"):
        own = [r for r in rows if r[0] == name]
        if len(own) > len(set(own)):
            wanted["sms-call-internet-mi-" + name] = len(own) - len(set(own))
    df = spark.createDataFrame(
        [(f"/in/sms-call-internet-mi-{f}", t, c, k) for f, t, c, k in rows],
        "_source_file string, datetime string, CellID string, countrycode string",
    )
    found = {r["filename"]: r["duplicate_rows"] for r in gate1.duplicate_check(df).collect()}
    assert found == wanted
    assert gate1.duplicate_check(df.distinct()).count() == 0


def test_header_in_a_split_file(spark, tmp_path):
    """Blocks after the first have no header."""
    lines = [line for cell in range(40) for line in day_lines(DAY, cell=str(cell))]
    write_day(tmp_path, DAY, lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        row = judge(spark, tmp_path)[DAY]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert (row["status"], row["row_count"]) == ("ACCEPTED", 960)


def test_spaces_in_the_path(spark, tmp_path):
    write_day(tmp_path / "in box", DAY, day_lines(DAY))
    write_day(tmp_path / "in box", "2013-11-02", ["x," + x for x in day_lines("2013-11-02")], "note," + HEADER)
    rows = judge(spark, tmp_path / "in box")
    assert {r["status"] for r in rows.values()} == {"ACCEPTED"}


def test_quotes_byte_order_mark_and_line_ends(spark, tmp_path):
    quoted = ",".join(f'"{name}"' for name in HEADER.split(","))
    write_day(tmp_path, DAY, [f'"{line.split(",", 1)[0]}",{line.split(",", 1)[1]}' for line in day_lines(DAY)], quoted)
    write_day(tmp_path, "2013-11-02", day_lines("2013-11-02"), "\ufeff" + HEADER)
    path = tmp_path / "sms-call-internet-mi-2013-11-03.csv"
    path.write_bytes("\r\n".join([HEADER, *day_lines("2013-11-03"), ""]).encode())
    rows = judge(spark, tmp_path)
    assert {k: (r["status"], r["row_count"]) for k, r in rows.items()} == {
        f"2013-11-0{n}": ("ACCEPTED", 24) for n in (1, 2, 3)
    }
    raw = landing.read_raw(spark, str(tmp_path))
    assert raw.count() == 72
    assert raw.where("datetime is null or internet <> '5'").count() == 0


def test_routing_and_log(spark, tmp_path):
    write_day(tmp_path / "landing", DAY, day_lines(DAY))
    write_day(tmp_path / "landing", "2013-11-02", day_lines("2013-11-02", hours=3))
    out = str(tmp_path / "out")
    for run, at in (("r1", datetime(2024, 1, 1)), ("r2", datetime(2024, 1, 2))):
        routed = ingest.ingest(spark, str(tmp_path / "landing"), out, run, at)
        counts = {r["status"]: r["count"] for r in routed.groupBy("status").count().collect()}
        assert counts == {"ACCEPTED": 24, "REJECTED": 3}
    log = ingest.read_log(spark, out)
    assert log.count() == 4
    last = {r["filename"][-14:-4]: r for r in reports.latest_log(log).collect()}
    assert last[DAY]["runs"] == 2 and last[DAY]["processed_at"] == datetime(2024, 1, 2)
    health = reports.ingestion_health(log).first()
    assert (health["files"], health["accepted"], health["rejected"]) == (2, 1, 1)
    assert (health["acceptance_percentage"], health["accepted_rows"]) == (50.0, 24)
    assert (tmp_path / "landing" / f"sms-call-internet-mi-{DAY}.csv").exists()


def test_delivery_date(spark):
    from pyspark.sql import functions as F

    names = ["sms-call-internet-mi-2013-11-01.csv", "sms-call-internet-mi-2013-13-01.csv", "sms-call-internet-mi-x.csv"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert [r[0] for r in df.select(landing.delivery_date(F.col("name"))).collect()] == [date(2013, 11, 1), None, None]


def test_header_with_a_comma_inside_quotes(spark, tmp_path):
    lines = [f'"a, b",{line}' for line in day_lines(DAY, values="1,2,3,4,7")]
    write_day(tmp_path, DAY, lines, f'"note, free",{HEADER}')
    row = judge(spark, tmp_path)[DAY]
    assert (row["status"], row["row_count"]) == ("ACCEPTED", 24)
    assert row["warnings"][0] == "Extra column(s): note, free"
    raw = landing.read_raw(spark, str(tmp_path))
    assert raw.where("internet = '7' and CellID = '1' and callout = '4'").count() == 24


@pytest.mark.parametrize("header", [HEADER, "note," + HEADER])
def test_files_that_are_no_text_are_rejected(spark, tmp_path, header):
    extra = "x," if header != HEADER else ""
    good = [extra + line for line in day_lines(DAY)]
    faults = {
        "2013-11-01": good[-1].encode()[:-1] + b"\xff\xfe",
        "2013-11-03": extra.encode() + b'2013-11-03 23:00:00,"1,39,1,2,3,4,5',
        "2013-11-04": good[-1].encode() + b",6,7",
    }
    for day, last in faults.items():
        path = tmp_path / f"sms-call-internet-mi-{day}.csv"
        path.write_bytes("\n".join([header, *good[:-1], ""]).encode() + last + b"\n")
    rows = judge(spark, tmp_path)
    assert {(r["status"], r["row_count"]) for r in rows.values()} == {("REJECTED", 0)}
    starts = [gate1.BAD_BYTES, gate1.OPEN_QUOTE, gate1.TOO_WIDE]
    for (day, row), start in zip(sorted(rows.items()), starts, strict=True):
        assert row["reason"].startswith(start), (day, row)
