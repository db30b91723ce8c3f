"""Stage, check, publish.

A run writes its tables below ``<table>/run_id=<run>/attempt=<attempt>`` and
nothing there is visible to readers. Every attempt has folders of its own, so a
retry under the same run id touches nothing that is published. Publishing
appends rows to a manifest, one per table and date; a reader takes for each
date the newest attempt in the manifest. So a failed run leaves the published
data as it was, no data is copied, and a date that is delivered again replaces
only itself.
"""

from __future__ import annotations

import json
import time
import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellpulse.functions.digest import DIGEST, content_by_date

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("has_rows", T.BooleanType()),
        T.StructField("schema", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("hash_xor", T.LongType()),
        T.StructField("hash_sum", T.DecimalType(38, 0)),
    ]
)


class PublicationRefused(RuntimeError):
    """A quality check failed; what was published before is untouched."""

    def __init__(self, failed: list[str]):
        super().__init__("not published, failed: " + ", ".join(failed))
        self.failed = failed


def new_attempt() -> str:
    """A name that no other attempt has; later attempts come later in order."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def run_path(output: str, table: str, run_id: str, attempt: str) -> str:
    return f"{output.rstrip('/')}/{table}/run_id={run_id}/attempt={attempt}"


def manifest_path(output: str) -> str:
    return f"{output.rstrip('/')}/_manifest"


def write_by_date(df: DataFrame, path: str, gather: bool = True) -> DataFrame:
    """Write Parquet, snappy, one folder per date; returns the table as stored.

    ``gather`` adds a rebalance by date, which adaptive execution splits into
    files of even size, so a busy date gets several writers and a quiet one a
    single file. Rows that already come in date order (daily files) do without.
    """
    rows = df.hint("rebalance", "date") if gather else df
    rows.write.mode("overwrite").option("compression", "snappy").partitionBy("date").parquet(path)
    return read_staged(df, path)


def read_staged(df: DataFrame, path: str) -> DataFrame:
    """What ``df`` was written as; its schema is known, also where it had no rows."""
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_dashboard_csv(summary: DataFrame, path: str, files: int = 1) -> None:
    """Network rollup as CSV with header, in time order.

    One row per hour: a century of hours fits one file. With more ``files`` each
    holds a range of times.
    """
    ordered = (
        summary.repartition(1) if files == 1 else summary.repartitionByRange(files, "timestamp")
    )
    ordered.sortWithinPartitions("timestamp").write.mode("overwrite").option("header", True).csv(path)


def require_passed(checks: DataFrame) -> None:
    """Raise unless every check row has passed. There are about twenty rows."""
    failed = [row["check_name"] for row in checks.where(~F.col("passed")).select("check_name").collect()]
    if failed:
        raise PublicationRefused(sorted(failed))


def publish(
    spark: SparkSession,
    output: str,
    run_id: str,
    attempt: str,
    tables: dict[str, DataFrame],
    contents: dict[str, DataFrame],
    published_at: datetime,
) -> None:
    """Make the staged tables of a run the current ones for all dates of the run: those of its first table.

    ``contents`` holds the digests of each table by date, which the manifest keeps.

    A table without rows on a date gets an entry too: the rows an earlier run had
    there are no longer current. All entries go out in one file of one task
    (dates times tables), so either all are visible or none.
    """
    run_dates = next(iter(contents.values())).select("date")
    rows = None
    for name, staged in tables.items():
        filled = contents[name]
        entry = run_dates.join(filled, F.equal_null(run_dates["date"], filled["date"]), "left").select(
            F.lit(name).alias("table"),
            run_dates["date"],
            F.lit(run_id).alias("run_id"),
            F.lit(attempt).alias("attempt"),
            F.col("n_rows").isNotNull().alias("has_rows"),
            F.lit(staged.schema.json()).alias("schema"),
            F.lit(published_at).cast("timestamp").alias("published_at"),
            *DIGEST,
        )
        rows = entry if rows is None else rows.unionByName(entry)
    rows.repartition(1).write.mode("append").parquet(manifest_path(output))


def current_runs(spark: SparkSession, output: str, table: str) -> DataFrame:
    """What is published, one row per date; of two runs at one time the later attempt wins."""
    newest = F.max(F.struct("published_at", "attempt", "run_id", "has_rows", "schema", *DIGEST))
    return (
        spark.read.schema(MANIFEST_SCHEMA)
        .parquet(manifest_path(output))
        .where(F.col("table") == table)
        .groupBy("date")
        .agg(newest.alias("last"))
        .select("date", "last.*")
    )


def read_published(spark: SparkSession, output: str, table: str) -> DataFrame:
    """The published rows of a table, with ``run_id``.

    Only the folders of the current run of each date are listed, and the schema
    comes from the manifest, so no file is opened before the query runs.
    """
    base = f"{output.rstrip('/')}/{table}"
    current = current_runs(spark, output, table).collect()  # one row per date
    if not current:
        raise LookupError(f"{table} has not been published in {output}")
    last = max(current, key=lambda row: (row["published_at"], row["attempt"]))
    schema = T.StructType.fromJson(json.loads(last["schema"])).add("run_id", T.StringType())
    paths = [
        f"{base}/run_id={row['run_id']}/attempt={row['attempt']}/date={row['date'] or '__HIVE_DEFAULT_PARTITION__'}"
        for row in current
        if row["has_rows"]
    ]
    if not paths:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", base).parquet(*paths)
    return found.select(*schema.names)


def published_content(spark: SparkSession, output: str, table: str) -> DataFrame:
    """For each published date, the rows stored now and whether they are those that were published.

    Entries from before digests were kept have none to compare with: ``unchanged`` is null.
    """
    then = current_runs(spark, output, table).select("date", "has_rows", *[F.col(c).alias(f"{c}_then") for c in DIGEST])
    now = content_by_date(read_published(spark, output, table).drop("run_id"))
    both = then.join(now.withColumnRenamed("date", "of_date"), F.equal_null("date", "of_date"), "left")
    same = [F.equal_null(c, f"{c}_then") for c in DIGEST]
    known = F.col("n_rows_then").isNotNull() | ~F.col("has_rows")
    return both.select(
        "date", F.coalesce("n_rows", F.lit(0)).alias("row_count"), F.when(known, same[0] & same[1] & same[2]).alias("unchanged")
    )


def is_published(spark: SparkSession, output: str, table: str) -> bool:
    """Whether any run of the table has been published."""
    try:
        return not current_runs(spark, output, table).isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def register_views(spark: SparkSession, output: str, tables: list[str]) -> None:
    """Published tables as SQL views of the same names."""
    for table in tables:
        read_published(spark, output, table).createOrReplaceTempView(table)

