"""Rollups from clean rows: per cell and hour, per cell and day, network-wide.

Every aggregation has partial sums before its shuffle, so a cell, hour or
country with a third of all rows reaches the network as one row per task.

Fixed values: the names of the output columns, which readers of the tables go by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellpulse.functions.measures import settled, share_of, total_columns
from cellpulse.schemas import HOURLY_COLUMNS, MEASURES


def hourly_grid_summary(clean: DataFrame) -> DataFrame:
    """One row per (timestamp, grid_id): countries are summed up.

    Totals are recomputed from the summed measures. Hours without rows stay
    absent; see ``hourly_spine`` for the complete grid.
    """
    summed = clean.groupBy("timestamp", "grid_id").agg(*[F.sum(m).alias(m) for m in MEASURES])
    share = share_of(F.col("internet_activity"), F.col("total_activity"))
    return (
        summed.withColumns(total_columns())
        .withColumns({"internet_share": share, "date": F.to_date("timestamp")})
        .select(*HOURLY_COLUMNS)
    )


def daily_traffic_summary(hourly: DataFrame) -> DataFrame:
    """Sums per (date, grid_id)."""
    return hourly.groupBy("date", "grid_id").agg(
        F.sum("total_activity").alias("daily_activity"),
        F.sum("total_sms").alias("daily_sms"),
        F.sum("total_calls").alias("daily_calls"),
        F.sum("internet_activity").alias("daily_internet"),
    )


def daily_grid_summary(hourly: DataFrame) -> DataFrame:
    """Total, mean, highest and lowest hourly activity per (grid_id, date), over the hours present."""
    activity = F.col("total_activity")
    return hourly.groupBy("grid_id", "date").agg(
        F.sum(activity).alias("daily_total_activity"),
        F.avg(activity).alias("daily_avg_activity"),
        F.max(activity).alias("daily_max_activity"),
        F.min(activity).alias("daily_min_activity"),
    )


def peak_hour(hourly: DataFrame) -> DataFrame:
    """The calendar hour with the highest network activity; the earliest one on a tie."""
    return (
        hourly.groupBy("timestamp")
        .agg(F.sum("total_activity").alias("total_activity"))
        .orderBy(settled(F.col("total_activity")).desc(), F.asc("timestamp"))
        .limit(1)
    )


def top_grids(hourly: DataFrame, k: int = 10) -> DataFrame:
    """The k busiest cells; lower grid_id first on a tie."""
    return (
        hourly.groupBy("grid_id")
        .agg(F.sum("total_activity").alias("total_grid_activity"))
        .orderBy(settled(F.col("total_grid_activity")).desc(), F.asc("grid_id"))
        .limit(k)
    )


def dashboard_summary(hourly: DataFrame) -> DataFrame:
    """Network totals per timestamp.

    The input has one row per (timestamp, grid_id), so a plain count is the
    number of active cells and no distinct count is needed.
    """
    return hourly.groupBy("timestamp").agg(
        F.sum("total_activity").alias("total_activity"),
        F.sum("total_sms").alias("total_sms"),
        F.sum("total_calls").alias("total_calls"),
        F.sum("internet_activity").alias("internet_activity"),
        F.count("*").alias("active_grid_count"),
    )
