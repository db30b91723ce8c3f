"""The batch: read, clean, aggregate, enrich, check, publish."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cellpulse.functions.digest import content_by_date, content_check, digest_columns
from cellpulse.operators import aggregate, analytics, clean, gate2, geo
from cellpulse.operators.gate1 import ACCEPTED
from cellpulse.plans.ingest import ingest
from cellpulse.plans.publish import (
    is_published,
    new_attempt,
    publish,
    read_published,
    read_staged,
    require_passed,
    run_path,
    write_by_date,
    write_dashboard_csv,
)
from cellpulse.schemas import RAW_COLUMNS, SOURCE_COLUMN
from cellpulse.session import prepare
from cellpulse.sources.geojson import grid_lookup, read_geojson
from cellpulse.sources.landing import delivery_date, delivery_name, read_raw

CHECKED, HOURLY = "checked_activity", "hourly_grid_summary"
WORKING_COLUMNS = ("row_status", "reasons", "raw_record", "missing_measures")


@dataclass(frozen=True)
class BatchResult:
    run_id: str
    metrics: dict
    checks: list
    outputs: dict


def stage_rows(raw: DataFrame, path: str, gather: bool = False) -> tuple[DataFrame, dict]:
    """Write valid and rejected rows from one scan; returns the stored table and the digest of the rows that went in.

    Daily files already hold one date each, so the write needs no shuffle.
    ``gather`` adds one for input that mixes dates.
    """
    seen = Observation()
    rows = clean.checked_rows(raw)
    shaped = rows.hint("rebalance", "date", "row_status") if gather else rows
    (
        shaped.observe(seen, *[c.alias(n) for n, c in digest_columns(rows.columns).items()])
        .write.mode("overwrite")
        .option("compression", "snappy")
        .partitionBy("date", "row_status")
        .parquet(path)
    )
    return read_staged(rows, path), seen.get


def stage_hourly(valid: DataFrame, path: str) -> tuple[DataFrame, dict]:
    """Write the hourly table by date; returns the stored table and the digest of the rows that went in.

    The digest is taken above the last shuffle, where a lost executor cannot make
    a task count twice.
    """
    seen = Observation()
    gathered = aggregate.hourly_grid_summary(valid).hint("rebalance", "date")
    counted = gathered.observe(seen, *[c.alias(n) for n, c in digest_columns(gathered.columns).items()])
    return write_by_date(counted, path, gather=False), seen.get


def published_history(
    spark: SparkSession, output: str, hourly: DataFrame, days: int
) -> DataFrame | None:
    """Published hourly rows up to ``days`` before or after the dates of ``hourly``, without those dates."""
    if days <= 0 or not is_published(spark, output, HOURLY):
        return None
    dates = [r["date"] for r in hourly.select("date").distinct().collect()]  # one per day of the run
    if not dates:
        return None
    first, last = min(dates) - timedelta(days=days), max(dates) + timedelta(days=days)
    near = F.col("date").between(first, last) & ~F.col("date").isin(dates)
    return read_published(spark, output, HOURLY).where(near)


def valid_rows(checked: DataFrame) -> DataFrame:
    """The clean table: a partition filter on the checked rows."""
    return checked.where(F.col("row_status") == clean.ROW_VALID).drop(*WORKING_COLUMNS)


def delivered_dates_check(checked: DataFrame) -> DataFrame:
    """Valid rows whose date no delivery of this run stands for.

    Publishing replaces whole dates. A stray row of another day must not replace
    that day, so it stops the run.
    """
    pairs = checked.groupBy("date", SOURCE_COLUMN).agg(
        F.count_if(F.col("row_status") == clean.ROW_VALID).alias("n")
    )
    named = pairs.withColumn("file_date", delivery_date(delivery_name(F.col(SOURCE_COLUMN))))
    by_date = named.where("n > 0").groupBy("date").agg(F.sum("n").alias("n"))
    stray = by_date.join(
        named.select(F.col("file_date").alias("date")).distinct(), "date", "left_anti"
    )
    return stray.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("observed")).select(
        F.lit("rows_of_delivered_dates").alias("check_name"),
        (F.col("observed") == 0).alias("passed"),
        "observed",
        F.lit(0.0).alias("expected"),
    )


def run_rows(
    spark: SparkSession,
    raw: DataFrame,
    output_folder: str,
    reference_path: str,
    run_id: str,
    run_at: datetime,
    start: date | None = None,
    end: date | None = None,
    multi_line_reference: bool = True,
    gather_input: bool = False,
    history_days: int = 0,
    min_represented: float = gate2.MIN_REPRESENTED,
    max_unknown: float = gate2.MAX_UNKNOWN,
    min_computable: float = gate2.MIN_COMPUTABLE,
) -> BatchResult:
    """All stages over raw rows; raises ``PublicationRefused`` if a check fails.

    ``history_days`` lets the baseline use that many published days around the
    days of this run, which a run over a single day needs. The last three are
    limits of checks, in percent; see ``gate2``.

    The input is parsed once. Everything after the first write reads columns of
    the staged tables. The caller owns the session; exceptions propagate.
    """
    began, attempt = time.monotonic(), new_attempt()

    def path_of(table: str) -> str:
        return run_path(output_folder, table, run_id, attempt)

    lookup = grid_lookup(read_geojson(spark, reference_path, multi_line_reference))
    lookup.write.mode("overwrite").parquet(path_of("grid_lookup"))
    lookup = read_staged(lookup, path_of("grid_lookup"))

    checked, rows_in = stage_rows(raw, path_of(CHECKED), gather_input)
    valid = valid_rows(checked)
    hourly, hourly_rows = stage_hourly(valid, path_of(HOURLY))
    stored = {CHECKED: checked, HOURLY: hourly}

    def store(table: str, frame: DataFrame) -> None:
        dated = frame if "date" in frame.columns else frame.withColumn("date", F.to_date("timestamp"))
        stored[table] = write_by_date(dated, path_of(table))

    store("daily_traffic_summary", aggregate.daily_traffic_summary(hourly))
    store("daily_grid_summary", aggregate.daily_grid_summary(hourly))
    history = published_history(spark, output_folder, hourly, history_days)
    store("hotspots", analytics.hotspots(analytics.grid_baseline(hourly, history)))
    store("activity_alerts", analytics.activity_alerts(stored["hotspots"], run_at))
    write_dashboard_csv(aggregate.dashboard_summary(hourly), path_of("dashboard_summary"))
    top = geo.enrich_with_geometry(aggregate.top_grids(hourly), lookup)
    top.write.mode("overwrite").parquet(path_of("top_grids_geo"))

    # Read back once: one digest per table and date, for the check and for the manifest.
    contents = {}
    for table, frame in stored.items():
        by_date = content_by_date(frame)
        by_date.write.mode("overwrite").parquet(path_of(f"{table}_content"))
        contents[table] = read_staged(by_date, path_of(f"{table}_content"))

    checks = (
        gate2.gate2_checks(
            hourly,
            stored["daily_traffic_summary"],
            stored["hotspots"],
            stored["activity_alerts"],
            lookup=lookup,
            compared=gate2.reconcile(valid, hourly),
            start=start,
            end=end,
            min_represented=min_represented,
            max_unknown=max_unknown,
            min_computable=min_computable,
        )
        .unionByName(delivered_dates_check(checked))
        .unionByName(content_check("checked_rows_readback", contents[CHECKED], rows_in))
        .unionByName(content_check("hourly_rows_readback", contents[HOURLY], hourly_rows))
    )
    checks.write.mode("overwrite").parquet(path_of("gate2_checks"))
    checks = read_staged(checks, path_of("gate2_checks"))

    valid_flag = F.col("row_status") == clean.ROW_VALID
    counts = checked.agg(
        F.count("*").alias("input_rows"),
        F.count_if(~valid_flag).alias("rejected_rows"),
        F.count_if(valid_flag).alias("cleaned_rows"),
        F.coalesce(F.sum("missing_measures"), F.lit(0)).alias("activity_nulls_handled"),
    ).first()
    peak = aggregate.peak_hour(hourly).first()
    metrics = {
        **counts.asDict(),
        "output_rows": hourly_rows["n_rows"],
        "lookup_rows": lookup.count(),
        "peak_hour": peak["timestamp"] if peak else None,
        **geo.geo_coverage(hourly, lookup).first().asDict(),
    }

    require_passed(checks)
    publish(spark, output_folder, run_id, attempt, stored, contents, run_at)
    metrics["duration_seconds"] = time.monotonic() - began
    unpartitioned = ("dashboard_summary", "top_grids_geo", "grid_lookup", "gate2_checks")
    return BatchResult(run_id, metrics, checks.collect(), {t: path_of(t) for t in unpartitioned})


def run_batch(
    spark: SparkSession,
    input_folder: str,
    output_folder: str,
    reference_path: str,
    run_id: str,
    run_at: datetime,
    **options,
) -> BatchResult:
    """The pipeline over every daily file of a folder, as it is."""
    prepare(spark)
    raw = read_raw(spark, input_folder)
    return run_rows(spark, raw, output_folder, reference_path, run_id, run_at, **options)


def run_landing(
    spark: SparkSession,
    landing: str,
    output_folder: str,
    reference_path: str,
    run_id: str,
    run_at: datetime,
    mode: str = "strict",
    **options,
) -> BatchResult:
    """File gate first, then the pipeline over the rows of the accepted files."""
    prepare(spark)
    routed = ingest(spark, landing, output_folder, run_id, run_at, mode)
    raw = routed.where(F.col("status") == ACCEPTED).select(*RAW_COLUMNS, SOURCE_COLUMN)
    return run_rows(spark, raw, output_folder, reference_path, run_id, run_at, **options)


def read_clean(spark: SparkSession, output: str) -> DataFrame:
    """Published valid rows."""
    return valid_rows(read_published(spark, output, CHECKED)).drop("run_id")


def read_rejected(spark: SparkSession, output: str) -> DataFrame:
    """Published rejected rows: the original text and the reasons."""
    rows = read_published(spark, output, CHECKED).where(F.col("row_status") == clean.ROW_REJECTED)
    return rows.select("raw_record.*", SOURCE_COLUMN, "reasons", "run_id")
