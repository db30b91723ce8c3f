"""Newly arrived files: pick them up once, and keep hourly totals up to date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpulse.operators.aggregate import hourly_grid_summary
from cellpulse.operators.clean import clean_activity
from cellpulse.plans.publish import write_by_date
from cellpulse.schemas import MEASURES, RAW_SCHEMA, SOURCE_COLUMN
from cellpulse.session import discard, exists, stored
from cellpulse.sources.landing import landing_glob, source_part

GRAIN = ("timestamp", "grid_id", "country_code")


def stream_raw(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Rows of files as they arrive, as text.

    ``enforceSchema`` is off: a file with another column order fails the query
    instead of being read by position. Such files go through the batch gate.
    """
    reader = (
        spark.readStream.schema(RAW_SCHEMA).option("header", True).option("enforceSchema", False)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(landing_glob(folder)).select(
        "*", source_part().alias(SOURCE_COLUMN)
    )


def copy_new_rows(raw: DataFrame, path: str, checkpoint: str) -> None:
    """Append the rows of files not seen before, then stop. A run without new files adds nothing."""
    query = (
        raw.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def append_first_deliveries(clean: DataFrame, path: str, checkpoint: str, sums: str | None = None) -> None:
    """Store each (time, cell, country) once, however often and however late it is delivered again.

    Copies inside a micro-batch are merged by an aggregation, which combines
    them before its shuffle, so a group of copies never meets in one task. Rows
    stored by earlier batches are found by a join with the dates of this batch
    only. Each batch overwrites its own folder, so a restart repeats no row.

    With ``sums`` the rows that a batch has added are summed per cell and hour
    there. Sums add up across batches, so no state is kept and no row is too late.
    """
    spark = clean.sparkSession
    others = [c for c in clean.columns if c not in (*GRAIN, "date")]
    schema = clean.select(*GRAIN, *others, "date", F.lit(0).cast("bigint").alias("batch_id")).schema

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        first = batch.groupBy(*GRAIN).agg(F.min(F.struct(*others)).alias("row"))
        rows = first.select(*GRAIN, "row.*", F.to_date("timestamp").alias("date"))
        kept = None
        if batch_id > 0:
            # Read twice, for its dates and for the join.
            rows = kept = stored(rows, "first")
            dates = [r["date"] for r in rows.select("date").distinct().collect()]  # a day or a few
            before = (
                spark.read.schema(schema)
                .parquet(path)
                .where(F.col("date").isin(dates) & (F.col("batch_id") < batch_id))
            )
            # The country code may be null, and null is a value of the grain here.
            same = [F.equal_null(rows[c], before[c]) for c in GRAIN]
            rows = rows.join(before, same, "left_anti")
        own = f"{path}/batch_id={batch_id}"
        rows.write.mode("overwrite").partitionBy("date").parquet(own)
        discard(kept)
        if sums:
            added = spark.read.schema(rows.schema).parquet(own)
            write_by_date(_summed(added), f"{sums}/level=0/batch_id={batch_id}")

    query = (
        clean.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _summed(rows: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", "timestamp").alias("timestamp")
    sums = rows.groupBy(hour, "grid_id").agg(*[F.sum(m).alias(m) for m in MEASURES])
    return sums.withColumn("date", F.to_date("timestamp"))


def windowed_totals(clean: DataFrame, delay: str = "2 days") -> DataFrame:
    """Hourly totals per cell as a stateful stream; an hour is final ``delay`` after it."""
    summed = (
        clean.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", "1 hour"), "grid_id")
        .agg(*[F.sum(m).alias(m) for m in MEASURES])
    )
    return summed.select(F.col("window.start").alias("timestamp"), "grid_id", *MEASURES)


SUMS_SCHEMA = (
    "timestamp timestamp, grid_id string, "
    + ", ".join(f"{m} double" for m in MEASURES)
    + ", level int, batch_id bigint, date date"
)


def _stored_sums(spark: SparkSession, path: str) -> DataFrame:
    """Sums that count: those of the last compaction, and of the batches after it."""
    found = spark.read.schema(SUMS_SCHEMA).parquet(path)
    merged = found.where("level = 1").select("batch_id").distinct().collect()  # from folder names; a few
    # A compaction counts once its marker is there, so one that is being written is not read in part.
    done = [r["batch_id"] for r in merged if exists(spark, f"{path}/level=1/batch_id={r['batch_id']}/_SUCCESS")]
    if not done:
        return found.where("level = 0")
    last = max(done)
    return found.where((F.col("level") == 1) & (F.col("batch_id") == last) | (F.col("level") == 0) & (F.col("batch_id") > last))


def compact_sums(spark: SparkSession, path: str) -> int | None:
    """Merge the sums of all batches so far into one folder by date; returns the last batch in it.

    Readers go by the newest compaction, so nothing that is read is overwritten.
    """
    now = _stored_sums(spark, path)
    last = now.agg(F.max("batch_id")).first()[0]
    if last is not None:
        write_by_date(_summed(now), f"{path}/level=1/batch_id={last}")
    return last


def read_hourly_sums(spark: SparkSession, path: str, dates: list[date] | None = None) -> DataFrame:
    """The hourly table from the sums of all batches, of all or some dates.

    Summing once more is the same aggregation as the first one.
    """
    sums = _stored_sums(spark, path)
    return hourly_grid_summary(sums if dates is None else sums.where(F.col("date").isin(dates)))


def hourly_from_landing(
    spark: SparkSession, folder: str, path: str, checkpoint: str, max_files: int | None = None
) -> DataFrame:
    """Bring the hourly sums up to date with a landing folder, and return the hourly table.

    What has been delivered before, under whatever name, adds nothing. First
    deliveries lie below ``path/rows``, their sums below ``path/sums``.
    """
    rows = clean_activity(stream_raw(spark, folder, max_files))
    append_first_deliveries(rows, f"{path}/rows", checkpoint, f"{path}/sums")
    return read_hourly_sums(spark, f"{path}/sums")
