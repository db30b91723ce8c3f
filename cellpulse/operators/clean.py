"""Row-level cleaning: parse, judge, keep or reject, fill, derive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpulse.functions.measures import total_columns
from cellpulse.functions.parsing import measure_of, timestamp_of
from cellpulse.schemas import (
    MEASURES,
    RAW_COLUMNS,
    RAW_MEASURES,
    RENAMES,
    REQUIRED_COLUMNS,
    SOURCE_COLUMN,
)
from cellpulse.sources.landing import delivery_date, delivery_name

ROW_VALID, ROW_REJECTED = "VALID", "REJECTED"


def rename_columns(raw: DataFrame) -> DataFrame:
    """Working names for the raw columns that are there; other columns stay as they are."""
    renamed = raw.withColumnsRenamed(RENAMES)
    missing = [c for c in REQUIRED_COLUMNS if c not in renamed.columns]
    if missing:
        raise ValueError(f"the input lacks {', '.join(missing)}")
    return renamed


def parse_rows(raw: DataFrame, formats: Sequence[str] | None = None) -> DataFrame:
    """Renamed rows with a typed time and typed measures; what cannot be parsed is null."""
    typed = {"timestamp": timestamp_of(F.col("timestamp"), formats)}
    typed.update({m: measure_of(F.col(m)) for m in MEASURES})
    return rename_columns(raw).withColumns(typed)


def faults() -> list[tuple[Column, str]]:
    """(condition, reason) of every fault a parsed row can have; no condition is ever null."""
    found = [
        (F.col("grid_id").isNull(), "missing grid_id"),
        (F.col("timestamp").isNull(), "invalid timestamp"),
    ]
    found += [(F.col(m).isNotNull() & (F.col(m) < 0), f"negative {m}") for m in MEASURES]
    return found


def is_invalid() -> Column:
    """The same as any fault, never null. ``least`` skips nulls, so each measure is evaluated once."""
    lowest = F.least(*[F.col(m) for m in MEASURES])
    return (
        F.col("grid_id").isNull()
        | F.col("timestamp").isNull()
        | F.coalesce(lowest < 0, F.lit(False))
    )


def fault_reasons() -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(text)) for c, text in faults()]))


def missing_measures() -> Column:
    """How many of the five measures a parsed row lacks."""
    return sum([F.col(m).isNull().cast("int") for m in MEASURES], start=F.lit(0))


def derive(parsed: DataFrame) -> DataFrame:
    """Null measures become 0.0; totals and calendar columns are added, ``date`` last."""
    filled = parsed.withColumns({m: F.coalesce(F.col(m), F.lit(0.0)) for m in MEASURES})
    return filled.withColumns(
        {
            **total_columns(),
            "hour": F.hour("timestamp"),
            "day_of_week": F.dayofweek("timestamp"),
            "date": F.to_date("timestamp"),
        }
    )


def clean_activity(raw: DataFrame, formats: Sequence[str] | None = None) -> DataFrame:
    """Valid rows, ready to aggregate. Columns beyond the expected ones pass through."""
    return derive(parse_rows(raw, formats).where(~is_invalid()))


def rejected_rows(raw: DataFrame, formats: Sequence[str] | None = None) -> DataFrame:
    """Invalid rows as they arrived, each with all its reasons."""
    kept = raw.withColumn("raw_record", F.struct(*[c for c in RAW_COLUMNS if c in raw.columns]))
    bad = parse_rows(kept, formats).where(is_invalid())
    others = [c for c in raw.columns if c not in RAW_COLUMNS]
    return bad.select("raw_record.*", *others, fault_reasons().alias("reasons"))


def checked_rows(raw: DataFrame, formats: Sequence[str] | None = None) -> DataFrame:
    """Valid and invalid rows in one frame, so that one scan can write both.

    ``row_status`` separates them. For invalid rows ``reasons`` and the original
    text in ``raw_record`` are set; for valid rows both are null and cost nothing
    in a columnar file. An invalid row without a time takes the date of its file.
    """
    kept = raw.withColumn("raw_record", F.struct(*[c for c in RAW_COLUMNS if c in raw.columns]))
    parsed = parse_rows(kept, formats).withColumn("invalid", is_invalid())
    judged = parsed.withColumns(
        {
            "row_status": F.when(F.col("invalid"), F.lit(ROW_REJECTED)).otherwise(F.lit(ROW_VALID)),
            "reasons": F.when(F.col("invalid"), fault_reasons()),
            "raw_record": F.when(F.col("invalid"), F.col("raw_record")),
            "missing_measures": missing_measures(),
        }
    ).drop("invalid")
    file_date = delivery_date(delivery_name(F.col(SOURCE_COLUMN)))
    return derive(judged).withColumn("date", F.coalesce("date", file_date))


def null_profile(raw: DataFrame, formats: Sequence[str] | None = None) -> DataFrame:
    """One row: missing values per measure, before the zero fill.

    ``*_nulls`` counts all rows, also those rejected later; ``valid_row_nulls``
    only the rows that are kept. ``cast_failures`` are texts that are no number.
    """
    texts = {f"text_{m}": F.col(r) for r, m in zip(RAW_MEASURES, MEASURES, strict=True)}
    parsed = parse_rows(raw.withColumns(texts), formats)
    missing = missing_measures()
    failed = sum(
        [(F.col(m).isNull() & F.col(f"text_{m}").isNotNull()).cast("int") for m in MEASURES],
        start=F.lit(0),
    )
    counts = [F.count_if(F.col(m).isNull()).alias(f"{m}_nulls") for m in MEASURES]
    return parsed.agg(
        F.count("*").alias("row_count"),
        *counts,
        F.coalesce(F.sum(missing), F.lit(0)).alias("activity_nulls_handled"),
        F.coalesce(F.sum(F.when(~is_invalid(), missing)), F.lit(0)).alias("valid_row_nulls"),
        F.coalesce(F.sum(failed), F.lit(0)).alias("cast_failures"),
    )


def run_metrics(raw: DataFrame, formats: Sequence[str] | None = None) -> DataFrame:
    """One row of run metrics from one scan and one shuffle of pre-aggregated rows.

    Output rows are the valid (time, cell) groups; input, rejected and null
    counts are sums over the same groups.
    """
    missing = missing_measures()
    groups = (
        parse_rows(raw, formats)
        .withColumns({"is_valid": ~is_invalid(), "missing": missing})
        .groupBy("is_valid", "timestamp", "grid_id")
        .agg(F.count("*").alias("n"), F.sum("missing").alias("missing"))
    )
    zero = F.lit(0).cast("bigint")
    return groups.agg(
        F.coalesce(F.sum("n"), zero).alias("input_rows"),
        F.coalesce(F.sum(F.when(~F.col("is_valid"), F.col("n"))), zero).alias("rejected_rows"),
        F.coalesce(F.sum(F.when(F.col("is_valid"), F.col("n"))), zero).alias("cleaned_rows"),
        F.coalesce(F.sum("missing"), zero).alias("activity_nulls_handled"),
        F.count_if("is_valid").alias("output_rows"),
    )
