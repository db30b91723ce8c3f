"""A digest of a set of rows that does not depend on their order or on how they are divided."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGEST = ("n_rows", "hash_xor", "hash_sum")


def digest_columns(columns: list[str]) -> dict[str, Column]:
    """Count, exclusive or, and sum of the row hashes.

    A row that is there twice leaves no trace in the exclusive or, but in the
    sum; a change that keeps the sum is found by the other.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(columns)])
    return {
        "n_rows": F.count(F.lit(1)),
        "hash_xor": F.coalesce(F.bit_xor(row), F.lit(0).cast("bigint")),
        "hash_sum": F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)"),
    }


def content_by_date(table: DataFrame) -> DataFrame:
    """The digest of each date's rows."""
    return table.groupBy("date").agg(*[c.alias(n) for n, c in digest_columns(table.columns).items()])


def whole_content(by_date: DataFrame) -> DataFrame:
    """The digest of all rows from those of their dates: digests add up."""
    return by_date.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.bit_xor("hash_xor"), F.lit(0).cast("bigint")).alias("hash_xor"),
        F.coalesce(F.sum("hash_sum"), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"),
    )


def content_check(name: str, by_date: DataFrame, expected: dict) -> DataFrame:
    """One check row: what was read back has the digest of what went in; observed and expected are row counts."""
    same = [F.col(c).eqNullSafe(F.lit(expected[c]).cast(t)) for c, t in whole_content(by_date).dtypes]
    return whole_content(by_date).select(
        F.lit(name).alias("check_name"),
        (same[0] & same[1] & same[2]).alias("passed"),
        F.col("n_rows").cast("double").alias("observed"),
        F.lit(float(expected["n_rows"])).alias("expected"),
    )
