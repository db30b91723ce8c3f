"""Expressions on the five measures and on ratios of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Derived ratios are rounded before any threshold is applied: the order in which
# a shuffle delivers rows moves the last bits of a double sum, and a flag must
# not depend on that.
RATIO_DIGITS = 6


def total_columns() -> dict[str, Column]:
    """The three derived sums, each from the measures themselves."""
    sms = F.col("sms_in") + F.col("sms_out")
    calls = F.col("call_in") + F.col("call_out")
    return {
        "total_sms": sms,
        "total_calls": calls,
        "total_activity": sms + calls + F.col("internet_activity"),
    }


def share_of(part: Column, whole: Column) -> Column:
    """part / whole where the whole is positive, else 0.0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def settled(value: Column) -> Column:
    """Rounded, in two steps: the first removes the noise that would decide a half in the second."""
    return F.round(F.round(value, 2 * RATIO_DIGITS), RATIO_DIGITS)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Rounded ratio, null where the denominator is null or zero."""
    return settled(F.try_divide(numerator, denominator))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100.0).otherwise(F.lit(0.0))
