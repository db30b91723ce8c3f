"""Content digests: what changes them, and what a change does to a publication."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from cellpulse.functions.digest import content_by_date, content_check, whole_content
from cellpulse.plans import publish

SCHEMA = "date date, a string, b double, c array<string>"
ROWS = [(date(2024, 1, 1), "x", 1.5, ["p"]), (date(2024, 1, 1), "y", None, None), (date(2024, 1, 2), None, -0.5, []), (None, "z", 2.0, ["q"])]


def digest(spark, rows):
    return tuple(whole_content(content_by_date(spark.createDataFrame(rows, SCHEMA).repartition(3))).first())


def test_order_does_not_matter_and_every_change_does(spark):
    own = digest(spark, ROWS)
    assert own == digest(spark, ROWS[::-1])
    assert own[0] == 4
    for changed in (
        [(*ROWS[0][:2], 1.6, ["p"]), *ROWS[1:]],
        [*ROWS[:3], (date(2024, 1, 3), *ROWS[3][1:])],
        [*ROWS[:2], ROWS[0], ROWS[0]],
        [*ROWS, ROWS[0], ROWS[0]],
    ):
        assert digest(spark, changed) != own
    assert digest(spark, []) == (0, 0, 0)


def test_one_changed_value_fails_the_check(spark):
    table = spark.createDataFrame(ROWS, SCHEMA)
    expected = whole_content(content_by_date(table)).first().asDict()
    assert content_check("c", content_by_date(table), expected).first()["passed"]
    changed = table.withColumn("b", F.when(F.col("a") == "x", 9.0).otherwise(F.col("b")))
    row = content_check("c", content_by_date(changed), expected).first()
    assert not row["passed"] and row["observed"] == row["expected"] == 4.0


def test_the_manifest_finds_what_was_changed_later(spark, tmp_path):
    from datetime import datetime

    out = str(tmp_path)
    table = spark.createDataFrame([r for r in ROWS if r[0]], SCHEMA)
    path = publish.run_path(out, "t", "r", "a1")
    stored = publish.write_by_date(table, path)
    publish.publish(spark, out, "r", "a1", {"t": stored}, {"t": content_by_date(stored)}, datetime(2024, 1, 3))
    state = lambda: sorted(map(tuple, publish.published_content(spark, out, "t").collect()))
    assert state() == [(date(2024, 1, 1), 2, True), (date(2024, 1, 2), 1, True)]
    changed = spark.createDataFrame([("x", 1.5, ["p"]), ("y", 7.0, None)], "a string, b double, c array<string>")
    changed.write.mode("overwrite").parquet(f"{path}/date=2024-01-01")
    assert state() == [(date(2024, 1, 1), 2, False), (date(2024, 1, 2), 1, True)]
