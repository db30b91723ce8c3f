"""Safe conversions from text. Under ANSI mode a plain cast fails the job on one bad value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def timestamp_of(text: Column, formats: Sequence[str] | None = None) -> Column:
    """Timestamp or null. The file gate and the cleaner call this with the same formats.

    Without formats Spark's own ISO date-time rule applies (and its fast parser).
    """
    if not formats:
        return F.try_to_timestamp(text)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def measure_of(text: Column) -> Column:
    """Double or null; ``NaN`` and infinite values count as missing, so that they cannot poison sums."""
    value = text.try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)  # NaN is above every number


def field_count(line: Column) -> Column:
    """Number of comma separated fields of one line; commas inside quotes do not count."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
