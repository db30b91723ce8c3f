"""Expected activity per cell and hour, what stands out from it, and gaps.

A hotspot is unusually high activity. It says nothing about congestion: there is
no load, throughput or latency in the data.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpulse.functions.measures import safe_ratio, settled, share_of

HOTSPOT_RATIO = 2.0
# Lowest ratio of each alert level, highest level first.
ALERT_LEVELS = (("CRITICAL", 5.0), ("HIGH", 3.0), ("MEDIUM", 2.0))
SPIKE = "SPIKE"
#: Rows of the spine that one task holds, for its aggregation and the sorts of the windows above it.
SPINE_ROWS = 200_000


def hour_statistics(hourly: DataFrame) -> DataFrame:
    """Sum, count and spread of activity per cell and hour of day: at most 24 rows a cell."""
    return hourly.groupBy("grid_id", F.hour("timestamp").alias("hour")).agg(
        F.sum("total_activity").alias("hour_sum"),
        F.count("*").alias("hour_count"),
        F.stddev_samp("total_activity").alias("hour_stddev"),
    )


def grid_baseline(hourly: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Each grid-hour with its expected activity: the mean of the same cell and hour on the other days.

    ``history`` adds hourly rows of other dates to the expectation, for a run
    that covers few days. The baseline is null if there is no other day.

    Statistics are aggregated and joined back rather than taken over a window:
    the aggregation shuffles partial sums only, and the join turns into a
    broadcast when the statistics measure small.
    """
    x = F.col("total_activity")
    others = F.col("hour_count") - 1
    needed = ["grid_id", "timestamp", "total_activity"]
    known = hourly.select(*needed)
    if history is not None:
        known = known.unionByName(history.select(*needed))
    rows = hourly.select(*needed, F.hour("timestamp").alias("hour"))
    baseline = F.when(others > 0, (F.col("hour_sum") - x) / others)
    return rows.join(hour_statistics(known), ["grid_id", "hour"]).select(
        "grid_id",
        "timestamp",
        "total_activity",
        settled(baseline).alias("baseline_activity"),
        F.col("hour_stddev").alias("activity_stddev"),
    )


def hotspots(baseline: DataFrame, min_ratio: float = HOTSPOT_RATIO) -> DataFrame:
    """Ratio to the baseline, distance from it in standard deviations, and the flag."""
    x, expected = F.col("total_activity"), F.col("baseline_activity")
    rated = baseline.withColumn("activity_ratio", safe_ratio(x, expected))
    # Equal values leave a spread of rounding noise; rounding makes it the zero it stands for.
    spread = settled(F.col("activity_stddev"))
    return rated.select(
        "grid_id",
        "timestamp",
        "total_activity",
        "baseline_activity",
        "activity_ratio",
        safe_ratio(x - expected, spread).alias("hotspot_score"),
        F.coalesce(F.col("activity_ratio") >= min_ratio, F.lit(False)).alias("hotspot_flag"),
    )


def level_of(ratio: Column, levels=ALERT_LEVELS) -> Column:
    """Alert level of a ratio, null below the lowest."""
    return F.coalesce(*[F.when(ratio >= lowest, F.lit(name)) for name, lowest in levels])


def alert_key(grid_id: Column, timestamp: Column, alert_type: Column) -> Column:
    """The same alert has the same id in every run."""
    when = F.date_format(timestamp, "yyyy-MM-dd HH:mm:ss")
    return F.sha2(F.concat_ws("|", grid_id, when, alert_type), 256)


def activity_alerts(spots: DataFrame, created_at: datetime, levels=ALERT_LEVELS) -> DataFrame:
    """One alert per grid-hour whose ratio reaches a level. ``created_at`` is the time of the run."""
    kind = F.lit(SPIKE)
    return (
        spots.withColumn("alert_level", level_of(F.col("activity_ratio"), levels))
        .where(F.col("alert_level").isNotNull())
        .select(
            alert_key(F.col("grid_id"), F.col("timestamp"), kind).alias("alert_id"),
            kind.alias("alert_type"),
            "grid_id",
            "timestamp",
            F.col("total_activity").alias("activity"),
            F.col("baseline_activity").alias("baseline"),
            F.col("activity_ratio").alias("ratio"),
            "alert_level",
            F.lit(created_at).cast("timestamp").alias("created_at"),
        )
    )


def spine_partitions(ids: DataFrame, first: Column, last: Column) -> int:
    """Tasks for the cells ``grid_id`` of ``ids`` at every hour from ``first`` to ``last``; two at least, so that rows are placed by cell."""
    hours = (F.unix_seconds(last) - F.unix_seconds(first)) / 3600 + 1
    sized = ids.agg(F.approx_count_distinct("grid_id").alias("cells")).select("cells", hours.cast("long").alias("hours"))
    size = sized.first()
    return max(2, -(-size["cells"] * (size["hours"] or 0) // SPINE_ROWS))


def hourly_spine(
    hourly: DataFrame,
    cells: DataFrame | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Every cell at every hour of the date range; hours without rows have ``is_missing``.

    Each cell expands its own sequence of hours, and the activity rows are added
    to these by one aggregation, so there is neither a cross join nor a join.
    The range is given, or runs from the first to the last day in the data.
    ``carried`` names more measures to sum up, null in hours without a value.

    Rows are placed by cell before the aggregation. It has next to nothing to
    combine, as both sides are unique per cell and hour, and windows by cell can
    follow without another shuffle. The number of partitions follows from cells
    and hours, which are counted first: these rows shrink so much in a shuffle
    that a size on the network says nothing about what a task has to hold.
    """
    found = hourly.agg(
        F.date_trunc("day", F.min("timestamp")).alias("first"),
        (F.date_trunc("day", F.max("timestamp")) + F.expr("INTERVAL 23 HOURS")).alias("last"),
    )
    first = F.lit(start).cast("timestamp") if start else found.select("first").scalar()
    last = F.lit(end).cast("timestamp") if end else found.select("last").scalar()
    ids = (hourly if cells is None else cells).select("grid_id").distinct()
    partitions = spine_partitions(ids, first, last)
    # Few bytes of ids become many rows, so they are spread before they are expanded.
    expected = ids.repartition(partitions, "grid_id").select(
        "grid_id",
        F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))).alias("timestamp"),
        F.lit(0.0).alias("total_activity"),
        F.lit(0.0).alias("internet_activity"),
        *[F.lit(None).cast("double").alias(f"carried_{c}") for c in carried],
        F.lit(0).alias("present"),
    )
    present = hourly.select(
        "grid_id",
        F.date_trunc("hour", "timestamp").alias("timestamp"),
        "total_activity",
        "internet_activity",
        *[F.col(c).alias(f"carried_{c}") for c in carried],
        F.lit(1).alias("present"),
    )
    return (
        expected.unionByName(present)
        .repartition(partitions, "grid_id")
        .groupBy("grid_id", "timestamp")
        .agg(
            F.sum("total_activity").alias("total_activity"),
            F.sum("internet_activity").alias("internet_activity"),
            *[F.sum(f"carried_{c}").alias(f"carried_{c}") for c in carried],
            (F.sum("present") == 0).alias("is_missing"),
        )
        .select(
            "grid_id",
            "timestamp",
            "total_activity",
            share_of(F.col("internet_activity"), F.col("total_activity")).alias("internet_share"),
            "is_missing",
            *[F.col(f"carried_{c}").alias(c) for c in carried],
        )
    )
