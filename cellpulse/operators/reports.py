"""Table queries behind the overview, explorer, alert and comparison views."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellpulse.functions.measures import safe_ratio, settled
from cellpulse.operators.aggregate import top_grids
from cellpulse.sources.landing import delivery_date

DAY_SECONDS = 86_400
# Severity of the alert levels, for ordering.
SEVERITY = {"MEDIUM": 1, "HIGH": 2, "CRITICAL": 3}


def severity_of(level: Column) -> Column:
    return F.coalesce(*[F.when(level == name, F.lit(rank)) for name, rank in SEVERITY.items()])


def network_kpis(hourly: DataFrame, alerts: DataFrame) -> DataFrame:
    """Per date: totals, active cells, the busiest hour (earliest on a tie), number of alerts."""
    cells = hourly.groupBy("date", "grid_id").agg(
        F.sum("total_activity").alias("activity"),
        F.sum("total_sms").alias("sms"),
        F.sum("total_calls").alias("calls"),
        F.sum("internet_activity").alias("internet"),
    )
    totals = cells.groupBy("date").agg(
        F.sum("activity").alias("total_activity"),
        F.sum("sms").alias("total_sms"),
        F.sum("calls").alias("total_calls"),
        F.sum("internet").alias("internet_activity"),
        F.count("*").alias("active_grids"),
    )
    hours = hourly.groupBy("date", "timestamp").agg(F.sum("total_activity").alias("activity"))
    rank = F.struct(settled(F.col("activity")), -F.col("timestamp").cast("bigint"))
    peaks = hours.groupBy("date").agg(F.max_by("timestamp", rank).alias("peak_hour"))
    counts = alerts.groupBy(F.to_date("timestamp").alias("date")).agg(F.count("*").alias("n"))
    return (
        totals.join(peaks, "date")
        .join(counts, "date", "left")
        .select("*", F.coalesce("n", F.lit(0)).alias("alert_count"))
        .drop("n")
    )


def grid_breakdown(hourly: DataFrame) -> DataFrame:
    """Per cell and hour: SMS, calls and internet with their shares of the total."""
    total = F.col("total_activity")
    return hourly.select(
        "grid_id",
        "timestamp",
        "total_sms",
        "total_calls",
        "internet_activity",
        safe_ratio(F.col("total_sms"), total).alias("sms_share"),
        safe_ratio(F.col("total_calls"), total).alias("calls_share"),
        safe_ratio(F.col("internet_activity"), total).alias("internet_share"),
    )


def alerts_page(
    alerts: DataFrame, page: int = 1, size: int = 50, alert_type: str | None = None
) -> DataFrame:
    """One page of alerts, newest first, by number: a distributed top-k of page times size rows.

    For going far back use ``alerts_after``, whose work does not grow with the page.
    """
    chosen = alerts if alert_type is None else alerts.where(F.col("alert_type") == alert_type)
    return chosen.orderBy(F.desc("timestamp"), "alert_id").offset((page - 1) * size).limit(size)


def alerts_after(
    alerts: DataFrame, timestamp: datetime, alert_id: str, size: int = 50, alert_type: str | None = None
) -> DataFrame:
    """The page that follows the given alert, the last one of the page before."""
    when = F.lit(timestamp).cast("timestamp")
    later = (F.col("timestamp") < when) | ((F.col("timestamp") == when) & (F.col("alert_id") > alert_id))
    return alerts_page(alerts.where(later), 1, size, alert_type)


def grid_severity(alerts: DataFrame, lookup: DataFrame) -> DataFrame:
    """Worst alert level and number of alerts per cell, with the cell's geometry."""
    worst = (
        alerts.withColumn("severity", severity_of(F.col("alert_level")))
        .groupBy("grid_id")
        .agg(F.max("severity").alias("severity"), F.count("*").alias("alert_count"), F.max("ratio").alias("max_ratio"))
    )
    name = F.coalesce(*[F.when(F.col("severity") == rank, F.lit(n)) for n, rank in SEVERITY.items()])
    return (
        worst.withColumn("worst_level", name)
        .drop("severity")
        .join(lookup.select("grid_id", "geometry"), "grid_id", "left")
    )


def alert_evidence(alerts: DataFrame, hourly: DataFrame) -> DataFrame:
    """Each alert with the hourly measures behind it."""
    facts = hourly.select(
        "grid_id", "timestamp", "total_sms", "total_calls", "internet_activity", "internet_share"
    )
    return alerts.select(
        "alert_id", "grid_id", "timestamp", "alert_level", "activity", "baseline", "ratio"
    ).join(facts, ["grid_id", "timestamp"])


def risk_evidence(scores: DataFrame, features: DataFrame, min_score: float) -> DataFrame:
    """Cells at risk with the features behind the score."""
    return (
        scores.where(F.col("risk_score") >= min_score)
        .select("grid_id", "timestamp", "risk_score", "risk_level")
        .join(features, ["grid_id", "timestamp"])
    )


def compare_grids(hourly: DataFrame, grid_a: str, grid_b: str) -> DataFrame:
    """Two cells side by side. One scan with a filter on both ids; no join of the table with itself."""
    activity = F.col("total_activity")
    return (
        hourly.where(F.col("grid_id").isin(grid_a, grid_b))
        .groupBy("timestamp")
        .agg(
            F.sum(F.when(F.col("grid_id") == grid_a, activity)).alias("activity_a"),
            F.sum(F.when(F.col("grid_id") == grid_b, activity)).alias("activity_b"),
        )
        .withColumn(
            "difference", F.coalesce("activity_a", F.lit(0.0)) - F.coalesce("activity_b", F.lit(0.0))
        )
    )


def compare_busiest(hourly: DataFrame) -> DataFrame:
    """Side by side for the two busiest cells; their ids (two values) become a scan filter."""
    ids = [row["grid_id"] for row in top_grids(hourly, 2).collect()]
    first, second = (ids + [None, None])[:2]
    return compare_grids(hourly, first, second)


def date_comparison(hourly: DataFrame) -> DataFrame:
    """Change against the same cell one day and seven days before, null where that hour has no row.

    Range frames find the row exactly that long ago, so gaps cannot shift it.
    Both frames share one shuffle by cell and hour of day.
    """
    seconds = F.col("timestamp").cast("bigint")
    same_hour = Window.partitionBy("grid_id", F.hour("timestamp")).orderBy(seconds)

    def ago(days: int):
        offset = -days * DAY_SECONDS
        return F.max("total_activity").over(same_hour.rangeBetween(offset, offset))

    return hourly.select(
        "grid_id",
        "timestamp",
        "total_activity",
        ago(1).alias("day_before"),
        ago(7).alias("week_before"),
    ).select(
        "*",
        (F.col("total_activity") - F.col("day_before")).alias("day_change"),
        (F.col("total_activity") - F.col("week_before")).alias("week_change"),
    )


def latest_log(log: DataFrame) -> DataFrame:
    """The newest log record of each file; reruns append, they do not replace."""
    newest = F.struct("processed_at", "status", "row_count", "reason")
    return (
        log.groupBy("filename")
        .agg(F.max(newest).alias("last"), F.count("*").alias("runs"))
        .select("filename", "last.status", "last.row_count", "last.reason", "last.processed_at", "runs")
    )


def daily_intake(log: DataFrame) -> DataFrame:
    """Per date of the file names: files, accepted files and rows, at the latest run of each file."""
    accepted = F.col("status") == "ACCEPTED"
    return (
        latest_log(log)
        .groupBy(delivery_date(F.col("filename")).alias("file_date"))
        .agg(
            F.count("*").alias("files"),
            F.count_if(accepted).alias("accepted"),
            F.sum("row_count").alias("row_count"),
            F.coalesce(F.sum(F.when(accepted, F.col("row_count"))), F.lit(0)).alias("accepted_rows"),
        )
    )


def ingestion_health(log: DataFrame) -> DataFrame:
    """One row: files, accepted and rejected at their latest run, acceptance in percent, rows accepted."""
    last = latest_log(log)
    accepted = F.col("status") == "ACCEPTED"
    return last.agg(
        F.count("*").alias("files"),
        F.count_if(accepted).alias("accepted"),
        F.count_if(~accepted).alias("rejected"),
        F.coalesce(F.sum(F.when(accepted, F.col("row_count"))), F.lit(0)).alias("accepted_rows"),
        F.sum("runs").alias("log_records"),
    ).withColumn(
        "acceptance_percentage",
        F.when(F.col("files") > 0, F.col("accepted") / F.col("files") * 100.0).otherwise(F.lit(0.0)),
    )
