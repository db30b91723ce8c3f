"""Drops: hours in which a cell stays below its usual activity for long enough to matter.

The usual activity of a cell at an hour of the day is its mean over all days,
hours without rows included. An hour's shortfall is what is missing of it, as a share, less an
allowance; a one-sided CUSUM adds shortfalls up and falls back to zero when
activity makes up for them. The fold ``s = max(0, s + shortfall)`` over a cell's
hours equals the running sum less its lowest value so far, so two windows over
one order give it, and a cell's hours are sorted once. Sums run on decimals: no order of
rows can move an hour over the limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellpulse.functions.measures import settled

#: Share of the usual activity that may be missing, and the sum of shortfalls that makes a drop.
ALLOWANCE, LIMIT = 0.5, 6.0
DROP = "DROP"


def drop_hours(spine: DataFrame, allowance: float = ALLOWANCE, limit: float = LIMIT) -> DataFrame:
    """Hours of the spine in which the sum of shortfalls is at its ``limit``, with the sum as ``drop_score``.

    Cells and hours of the day without any activity have no usual activity and no shortfall.
    """
    usual = spine.groupBy("grid_id", F.hour("timestamp").alias("hour")).agg(
        settled(F.avg("total_activity")).alias("usual_activity")
    )
    rows = spine.select("grid_id", "timestamp", F.hour("timestamp").alias("hour"), "total_activity").join(usual, ["grid_id", "hour"])
    missing = settled(1.0 - F.col("total_activity") / F.nullif(F.col("usual_activity"), F.lit(0.0)))
    shortfall = F.coalesce(missing.cast("decimal(18,6)") - F.lit(allowance).cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))
    so_far = Window.partitionBy("grid_id").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("shortfall", shortfall).withColumn("total", F.sum("shortfall").over(so_far))
    lowest = F.least(F.min("total").over(so_far), F.lit(0).cast("decimal(28,6)"))
    scored = rows.withColumn("drop_score", (F.col("total") - lowest).cast("double"))
    return scored.where(F.col("drop_score") >= limit).select(
        "grid_id", "timestamp", "total_activity", "usual_activity", "drop_score", F.lit(DROP).alias("alert_type")
    )


def drop_episodes(hours: DataFrame) -> DataFrame:
    """Drop hours that follow one another as one episode: start, end, hours, ``depth`` (its highest score), and what was missing."""
    in_order = Window.partitionBy("grid_id").orderBy("timestamp")
    place = F.unix_timestamp("timestamp") / 3600 - F.row_number().over(in_order)
    missing = F.col("usual_activity") - F.col("total_activity")
    return (
        hours.withColumn("island", place.cast("long"))
        .groupBy("grid_id", "island")
        .agg(
            F.min("timestamp").alias("start_time"),
            F.max("timestamp").alias("end_time"),
            F.count("*").alias("n_hours"),
            F.max("drop_score").alias("depth"),
            F.sum(missing).alias("missing_activity"),
        )
        .drop("island")
    )
