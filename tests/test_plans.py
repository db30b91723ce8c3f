"""What the plans must and must not contain."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from cellpulse.operators import aggregate, analytics, clean, reports, risk
from cellpulse.plans import publish
from cellpulse.schemas import RAW_SCHEMA

SF_DIR = "/root/testdata/sf0.001"
LAZY = (
    "clean_activity",
    "hourly_grid_summary",
    "dashboard_summary",
    "grid_activity_geo",
    "unmatched_grids",
    "geo_coverage",
    "hotspots",
    "hourly_spine",
    "risk_features",
    "date_comparison",
    "alert_evidence",
    "grid_severity",
    "gate2_checks",
    "network_kpis",
    "route_rows",
)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_join_and_no_python(spark, name):
    plan = plan_of(registry.queries()[name](spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert word not in plan


@pytest.fixture(scope="module")
def hourly(spark, tmp_path_factory):
    """A stored hourly table of two days."""
    raw = spark.range(5000).select(
        F.date_format(
            F.timestamp_seconds(F.lit(1383264000) + F.pmod(F.col("id"), F.lit(48)) * 3600), "yyyy-MM-dd HH:mm:ss"
        ).alias("datetime"),
        (F.col("id") / 100).cast("int").cast("string").alias("CellID"),
        F.lit("39").alias("countrycode"),
        *[F.lit("1.5").alias(c) for c in RAW_SCHEMA.names[3:]],
    )
    path = str(tmp_path_factory.mktemp("hourly") / "t")
    return publish.write_by_date(aggregate.hourly_grid_summary(clean.clean_activity(raw)), path)


def test_dates_and_columns_are_pruned(hourly):
    plan = plan_of(aggregate.dashboard_summary(hourly.where("date = '2013-11-01'")))
    assert "PartitionFilters: [isnotnull(date" in plan
    schema = plan.split("ReadSchema:")[1]
    assert "total_sms" in schema and "sms_in" not in schema


def test_cell_filter_reaches_the_scan(hourly):
    plan = plan_of(reports.compare_grids(hourly, "1", "2"))
    assert "PushedFilters: [In(grid_id, [1,2])]" in plan


def test_partial_sums_run_before_the_shuffle(hourly):
    for df in (aggregate.dashboard_summary(hourly), aggregate.daily_traffic_summary(hourly)):
        plan = plan_of(df)
        assert plan.index("HashAggregate") < plan.index("Exchange hashpartitioning") < plan.index("partial_sum")
        assert plan.count("Exchange") == 1 and "SortAggregate" not in plan


def test_top_k_is_not_a_global_sort(hourly):
    assert "TakeOrderedAndProject" in plan_of(aggregate.top_grids(hourly))
    assert "TakeOrderedAndProject" in plan_of(aggregate.peak_hour(hourly))


def test_windows_share_one_shuffle(hourly):
    assert plan_of(reports.date_comparison(hourly)).count("Exchange hashpartitioning") == 1
    plan = plan_of(risk.risk_features(analytics.hourly_spine(hourly)))
    above = plan[: plan.index("Union")]
    assert above.count("Window [") == 2 and above.count("Exchange hashpartitioning(grid_id") == 1


def test_clean_rows_are_written_without_a_shuffle(spark):
    raw = spark.createDataFrame([], RAW_SCHEMA).withColumn("_source_file", F.lit("x"))
    assert "Exchange" not in plan_of(clean.checked_rows(raw))


def test_a_hot_cell_gives_one_row_per_task_to_the_shuffle(spark):
    """Half of all rows in one cell and hour: the result is right and the shuffle stays small."""
    raw = spark.range(0, 200_000, 1, 8).select(
        F.lit("2013-11-01 05:00:00").alias("datetime"),
        F.when(F.col("id") % 2 == 0, "1").otherwise((F.col("id") % 100).cast("string")).alias("CellID"),
        F.lit("39").alias("countrycode"),
        *[F.lit("1").alias(c) for c in RAW_SCHEMA.names[3:]],
    )
    rows = {r["grid_id"]: r["sms_in"] for r in aggregate.hourly_grid_summary(clean.clean_activity(raw)).collect()}
    assert rows["1"] == 102_000.0 and sum(rows.values()) == 200_000.0
