"""Gate 1: is each arriving file trustworthy enough to enter the raw zone?

All files are judged together. One scan gives a profile with one row per part
and timestamp (24 rows for a proper day), and every check is arithmetic on that
small profile. Two modes:

* ``strict`` tests every measure for negatives, and adds the checks on the file
  name, on dates and cadence, and on duplicates. Empty or non-numeric measures
  are warnings.
* ``reference`` stops at the first measure that has an empty or non-numeric
  value and accepts the file there, and has no further checks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpulse.functions.parsing import field_count, measure_of, timestamp_of
from cellpulse.schemas import RAW_COLUMNS, RAW_MEASURES, SOURCE_COLUMN
from cellpulse.session import stored
from cellpulse.sources.landing import (
    CORRUPT,
    Listing,
    aligned_rows,
    delivery_date,
    delivery_name,
    detect_files,
    first_line_flags,
    header_lines,
    listing_of,
    scan_parts,
    text_faults,
    usual_layout,
)

HOURS_PER_DAY = 24
MODES = ("strict", "reference")

# Status and reason texts of the log.
ACCEPTED = "ACCEPTED"
REJECTED = "REJECTED"
ALL_PASSED = "All validation checks passed"
UNREADABLE = "Unable to read CSV: "
MISSING_COLUMNS = "Missing required column(s): "
ZERO_ROWS = "File contains zero rows"
MALFORMED_TIMES = "Malformed timestamp values: "
WRONG_HOURS = "Expected exactly {} distinct hourly timestamps, found "
NEGATIVE_VALUES = "Negative activity values found in {}: "
NON_NUMERIC = "Non-numeric values found in {}: "

# Texts of the checks that only strict mode has, and of warnings.
EMPTY_FILE = UNREADABLE + "No columns to parse from file"
TOO_WIDE = UNREADABLE + "rows with too many fields: "
BAD_BYTES = UNREADABLE + "rows with bytes that are no text: "
OPEN_QUOTE = UNREADABLE + "rows with an open quote: "
NO_DATE = "File name does not carry a date"
OTHER_DATE = "Rows of another date than the file name: "
OFF_HOUR = "Timestamps off the hour: "
WRONG_SPAN = "Hours between first and last timestamp: "
DUPLICATES = "Duplicate source rows: "
EXTRA_COLUMNS = "Extra column(s): "
OTHER_ORDER = "Columns are in another order"

UNREADABLE_COUNTERS = ("too_wide", "bad_bytes", "open_quote")
COUNTERS = (
    "lines",
    *UNREADABLE_COUNTERS,
    *[f"missing_{m}" for m in RAW_MEASURES],
    *[f"negative_{m}" for m in RAW_MEASURES],
)


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _profile(rows: DataFrame, formats: Sequence[str] | None) -> DataFrame:
    """Counts per part and timestamp; all buffers are longs, partial sums run before the shuffle."""
    values = {f"value_{m}": measure_of(F.col(m)) for m in RAW_MEASURES}
    typed = rows.withColumns({"ts": timestamp_of(F.col("datetime"), formats), **values})
    counts = [F.count("*").alias("lines"), *[F.count_if(c).alias(c) for c in UNREADABLE_COUNTERS]]
    for m in RAW_MEASURES:
        counts.append(F.count_if(F.col(f"value_{m}").isNull()).alias(f"missing_{m}"))
    for m in RAW_MEASURES:
        counts.append(F.count_if(F.col(f"value_{m}") < 0).alias(f"negative_{m}"))
    if "line_id" in rows.columns:
        counts += [c.alias(n) for n, c in first_line_flags().items()]
    return typed.groupBy("part", "ts").agg(*counts)


def _usual_rows(spark: SparkSession, paths) -> DataFrame:
    """Rows of all parts, read as if they had the usual layout. Header lines are among them."""
    scan = scan_parts(spark, paths, RAW_COLUMNS, header=False)
    return scan.withColumns(
        {
            "is_header": _all([F.col(n).eqNullSafe(F.lit(n)) for n in RAW_COLUMNS]),
            "too_wide": F.when(F.col(CORRUPT).isNull(), F.lit(False)).otherwise(
                field_count(F.col(CORRUPT)) > len(RAW_COLUMNS)
            ),
            **text_faults(RAW_COLUMNS),
        }
    ).drop(CORRUPT)


@dataclass(frozen=True)
class Profile:
    """What one pass over the files tells about them.

    ``counts`` is one row per part and timestamp, ``layouts`` one row per part
    with its column names. ``rows``, if kept, are the rows that were counted.
    """

    listing: Listing
    counts: DataFrame
    layouts: DataFrame
    rows: DataFrame | None


def profile_deliveries(
    spark: SparkSession,
    source: str | Listing,
    formats: Sequence[str] | None = None,
    keep_rows: bool = False,
) -> Profile:
    """Profile of all non-empty parts.

    The usual header is recognised during the scan itself; only parts with
    another first line are read once more, by name. With ``keep_rows`` the scan
    writes what it reads as columns, and everything after it reads those: the
    text is parsed once.
    """
    listing = listing_of(spark, source)
    if not listing.paths:
        return Profile(listing, _nothing(spark), _no_layouts(spark), _no_rows(spark))
    scanned = _usual_rows(spark, listing.paths)
    if keep_rows:
        scanned = stored(scanned, "scanned")
    first = stored(_profile(scanned, formats), "profile")
    per_part = first.groupBy("part").agg(
        F.min("first_line").alias("first_line"), F.min("first_header").alias("first_header")
    )
    usual = F.col("first_line").eqNullSafe(F.col("first_header"))
    parts = stored(per_part.select("part", "first_header", usual.alias("usual")), "parts")
    # A usual part counts its own header as one line with a bad time and five missing measures.
    is_header_group = F.col("first_header").isNotNull() & F.col("ts").isNull()
    header_adjusted = {
        name: F.col(name) - F.when(is_header_group, 1).otherwise(0)
        for name in ("lines", *[f"missing_{m}" for m in RAW_MEASURES])
    }
    good = parts.where("usual").select(F.col("part").alias("own"), F.col("first_header").alias("header_line"))
    counts = (
        first.join(good, F.col("part") == F.col("own"), "left_semi")
        .withColumns(header_adjusted)
        .select("part", "ts", *COUNTERS)
        .where("lines > 0")
    )
    layouts = good.select(F.col("own").alias("part"), usual_layout().alias("header"))
    columns = [*RAW_COLUMNS, "part"]
    rows = None
    if keep_rows:
        rows = scanned.join(good, F.col("part") == F.col("own")).where("line_id != header_line").select(columns)
    # Paths only, at most as many as the listing holds.
    unusual = [r["part"] for r in parts.where("not usual").select("part").collect()]
    if unusual:
        found = stored(header_lines(spark, unusual), "layouts")
        aligned = aligned_rows(spark, unusual, found)
        if keep_rows:
            aligned = stored(aligned, "aligned")
            rows = rows.unionByName(aligned.select(columns))
        again = stored(_profile(aligned, formats).select("part", "ts", *COUNTERS), "profile")
        counts = counts.unionByName(again)
        layouts = layouts.unionByName(found)
    return Profile(listing, counts, layouts, rows)


def _nothing(spark: SparkSession) -> DataFrame:
    counters = ", ".join(f"{c} long" for c in COUNTERS)
    return spark.createDataFrame([], f"part string, ts timestamp, {counters}")


def _no_layouts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "part string, header array<string>")


def _no_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in (*RAW_COLUMNS, "part")))


def schema_check(layouts: DataFrame) -> DataFrame:
    """Per delivery: required columns that a part lacks (rejects) and extra columns (a warning)."""
    required = usual_layout()
    named = layouts.withColumn("filename", delivery_name(F.col("part")))
    # A delivery has every required column only if each of its parts has it.
    return (
        named.withColumns(
            {
                "lacking": F.array_except(required, F.col("header")),
                "extra": F.array_except(F.col("header"), required),
                "in_order": F.slice("header", 1, len(RAW_COLUMNS)) == required,
            }
        )
        .groupBy("filename")
        .agg(
            *[F.max(F.array_contains("lacking", n)).alias(f"lacks_{n}") for n in RAW_COLUMNS],
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("extra")))).alias("extra_columns"),
            F.min("in_order").alias("usual_order"),
        )
        .select(
            "filename",
            F.array_compact(
                F.array(*[F.when(F.col(f"lacks_{n}"), F.lit(n)) for n in RAW_COLUMNS])
            ).alias("missing_columns"),
            "extra_columns",
            "usual_order",
        )
    )


def cadence_check(profile: DataFrame) -> DataFrame:
    """Per delivery: distinct times, times off the hour, first to last in hours, dates other than the name's."""
    hours = F.col("hours")
    return (
        profile.withColumn("filename", delivery_name(F.col("part")))
        .groupBy("filename", "ts")
        .agg(F.sum("lines").alias("lines"))
        .withColumn("file_date", delivery_date(F.col("filename")))
        .groupBy("filename")
        .agg(
            F.count("ts").alias("distinct_times"),
            F.coalesce(
                F.sum(F.when(F.col("ts") != F.date_trunc("hour", "ts"), F.col("lines"))), F.lit(0)
            ).alias("off_hour_rows"),
            F.timestamp_diff("HOUR", F.min("ts"), F.max("ts")).alias("hours"),
            F.coalesce(
                F.sum(F.when(F.to_date("ts") != F.col("file_date"), F.col("lines"))), F.lit(0)
            ).alias("other_date_rows"),
        )
        .withColumn("span_hours", F.coalesce(hours, F.lit(0)))
        .drop("hours")
    )


def duplicate_check(rows: DataFrame, path: str = SOURCE_COLUMN) -> DataFrame:
    """Per delivery: rows beyond the first at the source grain (time, cell, country).

    Nearly all rows of a sound file are unique, so a first pass shuffles only two
    hashes of the key, twelve bytes a row. The rows with a repeated pair of
    hashes are then counted by their full key, which makes the result exact;
    they find the pairs by a join that adaptive execution plans by their size.

    Both counts combine before their shuffle, so a key that fills a third of a
    file crosses the network as one row per task.
    """
    keys = ["filename", "datetime", "CellID", "countrycode"]
    named = rows.select(delivery_name(F.col(path)).alias("filename"), *keys[1:])
    hashed = named.withColumns({"wide": F.xxhash64(*keys), "narrow": F.hash(*keys)})
    repeated = hashed.groupBy("wide", "narrow").agg(F.count("*").alias("n")).where("n > 1")
    repeated = stored(repeated.select("wide", "narrow"), "repeated")
    return (
        hashed.join(repeated, ["wide", "narrow"], "left_semi")
        .groupBy(*keys)
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
        .groupBy("filename")
        .agg(F.sum(F.col("copies") - 1).alias("duplicate_rows"))
    )


def _texts(pairs) -> Column:
    """Array of the texts whose condition holds, in the given order."""
    return F.array_compact(F.array(*[F.when(condition, text) for condition, text in pairs]))


def _numbered(text: str, name: str) -> Column:
    return F.concat(F.lit(text), F.col(name).cast("string"))


def verdicts(
    files: DataFrame,
    profile: DataFrame,
    layouts: DataFrame,
    duplicates: DataFrame | None = None,
    mode: str = "strict",
    expected_hours: int = HOURS_PER_DAY,
) -> DataFrame:
    """One row per delivery: status, first reason, all reasons, warnings.

    The order of checks is fixed: layout, empty, time, number of times, then the
    measures in file order. ``expected_hours`` is 23 or 25 on clock-change days
    of local-time data.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    strict = mode == "strict"
    totals = (
        profile.withColumn("filename", delivery_name(F.col("part")))
        .withColumn("bad_time", F.when(F.col("ts").isNull(), F.col("lines")).otherwise(0))
        .groupBy("filename")
        .agg(*[F.sum(c).alias(c) for c in (*COUNTERS, "bad_time")])
    )
    listed = files.groupBy("filename").agg(F.sum("length").alias("bytes"))
    facts = (
        listed.join(totals, "filename", "left")
        .join(schema_check(layouts), "filename", "left")
        .join(cadence_check(profile), "filename", "left")
    )
    if duplicates is not None:
        facts = facts.join(duplicates, "filename", "left")
    else:
        facts = facts.withColumn("duplicate_rows", F.lit(0))
    zeros = [*COUNTERS, "bad_time", "distinct_times", "off_hour_rows", "span_hours", "other_date_rows", "duplicate_rows"]
    facts = facts.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zeros})
    facts = facts.withColumn("file_date", delivery_date(F.col("filename")))

    broken = F.greatest(*UNREADABLE_COUNTERS) > 0
    unreadable = (F.col("bytes") == 0) | broken
    lacks = F.size("missing_columns") > 0
    readable = ~unreadable & ~F.coalesce(lacks, F.lit(False))
    empty = F.col("lines") == 0
    judged = readable & ~empty
    times_ok = F.col("bad_time") == 0

    structure = [
        (F.col("bytes") == 0, F.lit(EMPTY_FILE)),
        (F.col("too_wide") > 0, _numbered(TOO_WIDE, "too_wide")),
        (F.col("bad_bytes") > 0, _numbered(BAD_BYTES, "bad_bytes")),
        (F.col("open_quote") > 0, _numbered(OPEN_QUOTE, "open_quote")),
        (~unreadable & lacks, F.concat(F.lit(MISSING_COLUMNS), F.array_join("missing_columns", ", "))),
        (readable & empty, F.lit(ZERO_ROWS)),
        (judged & ~times_ok, _numbered(MALFORMED_TIMES, "bad_time")),
        (
            judged & times_ok & (F.col("distinct_times") != expected_hours),
            _numbered(WRONG_HOURS.format(expected_hours), "distinct_times"),
        ),
    ]
    negatives = []
    seen_gap = F.lit(False)
    for m in RAW_MEASURES:
        has_gap = F.col(f"missing_{m}") > 0
        seen_gap = seen_gap | has_gap
        applies = judged & (F.col(f"negative_{m}") > 0)
        if not strict:
            # A column with a gap ends the checks with an accept, and so hides what follows it.
            applies = applies & ~seen_gap
        negatives.append((applies, _numbered(NEGATIVE_VALUES.format(m), f"negative_{m}")))
    extra = [
        (F.col("file_date").isNull(), F.lit(NO_DATE)),
        (judged & (F.col("other_date_rows") > 0), _numbered(OTHER_DATE, "other_date_rows")),
        (judged & (F.col("off_hour_rows") > 0), _numbered(OFF_HOUR, "off_hour_rows")),
        (
            judged & times_ok & (F.col("distinct_times") == expected_hours) & (F.col("span_hours") != expected_hours - 1),
            _numbered(WRONG_SPAN, "span_hours"),
        ),
        (judged & (F.col("duplicate_rows") > 0), _numbered(DUPLICATES, "duplicate_rows")),
    ]
    failures = _texts([*structure, *negatives, *(extra if strict else [])])
    warnings = _texts(
        [
            *[
                (judged & (F.col(f"missing_{m}") > 0), _numbered(NON_NUMERIC.format(m), f"missing_{m}"))
                for m in RAW_MEASURES
            ],
            (F.size("extra_columns") > 0, F.concat(F.lit(EXTRA_COLUMNS), F.array_join("extra_columns", ", "))),
            (~F.col("usual_order"), F.lit(OTHER_ORDER)),
        ]
    )
    return (
        facts.withColumns({"reasons": failures, "warnings": warnings})
        .withColumns(
            {
                "status": F.when(F.size("reasons") == 0, ACCEPTED).otherwise(REJECTED),
                "row_count": F.when(unreadable, F.lit(0)).otherwise(F.col("lines")).cast("bigint"),
                "reason": F.coalesce(F.get("reasons", F.lit(0)), F.lit(ALL_PASSED)),
            }
        )
        .select("filename", "status", "row_count", "reason", "reasons", "warnings")
    )


def judge_landing(
    spark: SparkSession,
    source: str | Listing,
    mode: str = "strict",
    formats: Sequence[str] | None = None,
    expected_hours: int = HOURS_PER_DAY,
    keep_rows: bool = False,
) -> tuple[DataFrame, Profile]:
    """Verdicts on all deliveries of a landing folder, and the profile they rest on."""
    strict = mode == "strict"
    profile = profile_deliveries(spark, source, formats, keep_rows or strict)
    duplicates = duplicate_check(profile.rows, "part") if strict else None
    files = detect_files(spark, profile.listing)
    found = verdicts(files, profile.counts, profile.layouts, duplicates, mode, expected_hours)
    return found, profile
