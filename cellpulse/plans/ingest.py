"""File gate as a job: judge all deliveries, route their rows, append the log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpulse.operators.gate1 import judge_landing
from cellpulse.plans.publish import new_attempt, run_path
from cellpulse.schemas import LOG_SCHEMA, SOURCE_COLUMN
from cellpulse.session import stored
from cellpulse.sources.landing import delivery_name

LOG = "ingestion_log"
ROUTED = "routed_rows"


def log_records(verdicts: DataFrame, processed_at: datetime) -> DataFrame:
    """One log record per delivery."""
    return verdicts.select(
        "filename",
        "status",
        "row_count",
        "reason",
        F.lit(processed_at).cast("timestamp").alias("processed_at"),
    )


def append_log(records: DataFrame, output: str) -> None:
    """Append to the log. Reruns add records; see ``latest_log`` for one per file."""
    records.write.mode("append").parquet(f"{output.rstrip('/')}/{LOG}")


def read_log(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(f"{output.rstrip('/')}/{LOG}")


def route_rows(raw: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Every row with the verdict of its delivery; the landing files stay where they are."""
    judged = verdicts.select("filename", "status", "reason")
    named = raw.withColumn("filename", delivery_name(F.col(SOURCE_COLUMN)))
    return named.join(judged, "filename")


def ingest(
    spark: SparkSession,
    landing: str,
    output: str,
    run_id: str,
    processed_at: datetime,
    mode: str = "strict",
) -> DataFrame:
    """Judge a landing folder; write raw and rejected rows as text; append the log.

    Returns the routed rows, which are the very rows that were judged. They are
    stored by ``status``, so reading the accepted ones touches their folder only.
    """
    verdicts, profile = judge_landing(spark, landing, mode, keep_rows=True)
    verdicts = stored(verdicts, "verdicts")
    path = run_path(output, ROUTED, run_id, new_attempt())
    routed = route_rows(profile.rows.withColumnRenamed("part", SOURCE_COLUMN), verdicts)
    routed.write.mode("error").partitionBy("status").parquet(path)
    append_log(log_records(verdicts, processed_at), output)
    return spark.read.schema(routed.schema).parquet(path)
