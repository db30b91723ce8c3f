"""Daily activity files: find them, learn their column layout, read them.

A delivery is what arrives for one day under the name
``sms-call-internet-mi-YYYY-MM-DD.csv``: either one file, or a folder of that
name holding part files (a large day written by a cluster). Every part carries
its own header line.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpulse.functions.parsing import field_count
from cellpulse.schemas import RAW_COLUMNS, RAW_SCHEMA, SOURCE_COLUMN, text_schema
from cellpulse.session import stored

# The file name pattern.
NAME_PREFIX = "sms-call-internet-mi-"
NAME_GLOB = "*sms-call-internet-mi-*.csv"
NAME_DATE_PATTERN = r"^sms-call-internet-mi-(\d{4}-\d{2}-\d{2})\.csv$"

CORRUPT = "_corrupt_record"


def landing_glob(folder: str) -> str:
    return f"{folder.rstrip('/')}/{NAME_GLOB}"


def delivery_name(path: Column) -> Column:
    """Name of the delivery a path belongs to (cheap string steps, as it runs per row)."""
    tail = F.substring_index(F.substring_index(path, NAME_PREFIX, -1), "/", 1)
    return F.concat(F.lit(NAME_PREFIX), tail)


def source_part() -> Column:
    """Path of the part a row comes from; to be selected directly on a scan.

    The per-row functions cost a third less than the ``_metadata`` column here.
    """
    path = F.input_file_name()
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    # Only paths that have an encoded character pay for the decoding.
    return F.when(F.contains(path, F.lit("%")), decoded).otherwise(path)


def delivery_date(filename: Column) -> Column:
    """Date in the delivery name, null if the name does not carry one."""
    text = F.regexp_extract(filename, NAME_DATE_PATTERN, 1)
    return F.to_date(F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit("yyyy-MM-dd")))


def plain_path(path: str) -> str:
    """A path as the file listing spells it; scans put more slashes behind ``file:``."""
    return re.sub("^file:/+", "file:/", path)


@dataclass(frozen=True)
class Listing:
    """The parts of a landing folder at one moment: path, length and time of each.

    Everything that a run does with the folder goes by one listing, so a part
    that arrives in between belongs to the next run. A scan holds the same list
    on the driver anyway.
    """

    folder: str
    parts: tuple[tuple[str, int, datetime | None], ...]

    @property
    def paths(self) -> list[str]:
        """Parts that have content."""
        return [path for path, length, _ in self.parts if length > 0]


def freeze_listing(spark: SparkSession, folder: str) -> Listing:
    """List a landing folder; fails early when it is missing or holds no daily file.

    Empty parts are listed too, although a scan skips them. No content is read.
    """
    try:
        scan = spark.read.format("binaryFile").load(landing_glob(folder))
        uris = scan.inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        uris = []
    if not uris:
        raise FileNotFoundError(f"no {NAME_PREFIX}*.csv below {folder}")
    sized = {r["path"]: r for r in scan.select("path", "length", "modificationTime").collect()}
    parts = []
    for path in sorted(plain_path(unquote(uri)) for uri in uris):
        row = sized.get(path)
        parts.append((path, row["length"] if row else 0, row["modificationTime"] if row else None))
    return Listing(folder, tuple(parts))


def listing_of(spark: SparkSession, source: str | Listing) -> Listing:
    return source if isinstance(source, Listing) else freeze_listing(spark, source)


def detect_files(spark: SparkSession, source: str | Listing) -> DataFrame:
    """Listed parts with their size and time."""
    parts = list(listing_of(spark, source).parts)
    files = spark.createDataFrame(parts, "path string, length long, modified_at timestamp")
    return files.select(delivery_name(F.col("path")).alias("filename"), "path", "length", "modified_at")


def detect_deliveries(spark: SparkSession, source: str | Listing) -> DataFrame:
    """One row per delivery, in name order."""
    return (
        detect_files(spark, source)
        .groupBy("filename")
        .agg(
            F.count("*").alias("parts"),
            F.sum("length").alias("bytes"),
            F.max("modified_at").alias("modified_at"),
        )
        .withColumn("file_date", delivery_date(F.col("filename")))
        .orderBy("filename")
    )


def scan_parts(spark: SparkSession, paths, names: Sequence[str], header: bool) -> DataFrame:
    """Positional text scan of whole parts, one string column per field.

    ``columnPruning`` is off so that a row with too many or too few fields is
    recognised, whatever columns the caller goes on to use.
    """
    schema = text_schema([*names, CORRUPT])
    scan = (
        spark.read.schema(schema)
        .option("header", header)
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(paths)
    )
    return scan.withColumns(
        {
            "part": source_part(),
            "block_start": F.input_file_block_start(),
            "line_id": F.monotonically_increasing_id(),
        }
    )


def text_faults(columns: Sequence[str]) -> dict[str, Column]:
    """Faults of the text itself: a byte that is no UTF-8, replaced on reading, and a quote that is never closed.

    A quote that stays open swallows the fields behind it, so its line is among
    those that do not fit. The reader closes one that opens in the last field,
    which is therefore not found.
    """
    line = F.col(CORRUPT)
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    replaced = F.lit(False)
    for name in (CORRUPT, *columns):
        replaced = replaced | F.coalesce(F.contains(F.col(name), F.lit("\uFFFD")), F.lit(False))
    return {"bad_bytes": replaced, "open_quote": F.coalesce(quotes % 2 == 1, F.lit(False))}


def first_line_flags() -> dict[str, Column]:
    """Aggregates that tell whether the first line of a part is the usual header.

    ``line_id`` grows with the position inside a file block. Both buffers are
    longs, so the aggregation stays a hash aggregation without a sort.
    """
    first_block = F.col("block_start") == 0
    return {
        "first_line": F.min(F.when(first_block, F.col("line_id"))),
        "first_header": F.min(F.when(first_block & F.col("is_header"), F.col("line_id"))),
    }


def header_lines(spark: SparkSession, paths) -> DataFrame:
    """(part, header): the column names of each given part, its first line read by the rules of CSV."""
    lines = (
        spark.read.text(paths)
        .select(
            source_part().alias("part"),
            F.input_file_block_start().alias("block_start"),
            F.monotonically_increasing_id().alias("line_id"),
            "value",
        )
        .where((F.col("block_start") == 0) & (F.trim("value") != ""))
    )
    bare = F.regexp_replace(F.min_by("value", "line_id"), "^\\uFEFF|\r$", "")
    first = stored(lines.groupBy("part").agg(bare.alias("line")), "headers")
    first = first.withColumn("n", field_count(F.col("line")))
    width = first.agg(F.max("n")).first()[0] or 0
    if not width:
        return first.select("part", F.array().cast("array<string>").alias("header"))
    slots = [f"field_{i}" for i in range(width)]
    fields = F.from_csv("line", ", ".join(f"{s} string" for s in slots))
    named = F.array(*[F.coalesce(F.col(f"fields.{s}"), F.lit("")) for s in slots])
    return first.withColumn("fields", fields).select("part", F.slice(named, F.lit(1), F.col("n")).alias("header"))


def unusual_parts(spark: SparkSession, paths) -> list[str]:
    """Parts whose first line is not the usual header, found with one pass over the text.

    The file gate learns the same from its own scan; this is for callers that
    read without having run the gate. The list holds paths only, which the
    driver holds anyway as the file listing of the scan.
    """
    lines = (
        spark.read.text(paths)
        .select(
            source_part().alias("part"),
            F.input_file_block_start().alias("block_start"),
            F.monotonically_increasing_id().alias("line_id"),
            (F.col("value") == ",".join(RAW_COLUMNS)).alias("is_header"),
            "value",
        )
        .where((F.col("block_start") == 0) & (F.trim("value") != ""))
        .drop("value")
    )
    flags = lines.groupBy("part").agg(*[c.alias(n) for n, c in first_line_flags().items()])
    odd = flags.where(~F.col("first_line").eqNullSafe(F.col("first_header")))
    return [row["part"] for row in odd.select("part").collect()]


def aligned_rows(spark: SparkSession, parts: list[str], layouts: DataFrame) -> DataFrame:
    """Rows of parts with any column order or extra columns, aligned by column name.

    ``layouts`` is (part, header). All layouts are read in one scan: each row
    looks its columns up in the header of its own part. A column that the part
    does not have is null. ``too_wide`` marks rows with more fields than names.
    """
    width = layouts.agg(F.max(F.size("header")).alias("w")).first()["w"]
    slots = [f"field_{i}" for i in range(width)]
    scan = scan_parts(spark, parts, slots, header=True)
    rows = scan.join(layouts, "part")
    fields = F.when(F.col(CORRUPT).isNull(), F.lit(width)).otherwise(field_count(F.col(CORRUPT)))
    values = F.array(*slots)
    by_name = [
        F.when(
            F.array_contains("header", name),
            F.get(values, (F.array_position("header", F.lit(name)) - 1).cast("int")),
        ).alias(name)
        for name in RAW_COLUMNS
    ]
    return rows.select(
        *by_name,
        "part",
        "header",
        (fields > F.size("header")).alias("too_wide"),
        *[c.alias(n) for n, c in text_faults(slots).items()],
    )


def usual_layout() -> Column:
    """The usual column names, in order."""
    return F.array(*[F.lit(n) for n in RAW_COLUMNS])


def read_raw(spark: SparkSession, source: str | Listing) -> DataFrame:
    """All activity rows as text, tagged with the source part, aligned by column name.

    Parts with the usual columns go through Spark's CSV reader as they are.
    Parts with another layout are found by a pass over the text and aligned by
    name; the file gate keeps the rows it has read instead.
    """
    paths = listing_of(spark, source).paths
    odd = unusual_parts(spark, paths)
    usual = sorted(set(paths) - set(map(plain_path, odd)))
    rows = None
    if usual or not odd:
        scan = spark.read.schema(RAW_SCHEMA).option("header", True)
        frame = scan.csv(usual) if usual else spark.createDataFrame([], RAW_SCHEMA)
        rows = frame.select("*", source_part().alias(SOURCE_COLUMN))
    if not odd:
        return rows
    aligned = aligned_rows(spark, odd, header_lines(spark, odd))
    aligned = aligned.select(*RAW_COLUMNS, F.col("part").alias(SOURCE_COLUMN))
    return aligned if rows is None else rows.unionByName(aligned)
