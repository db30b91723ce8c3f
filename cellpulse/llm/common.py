"""What several operators share: words, tables in the shared folder, bindings inside expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpulse.session import prepare, stored

__all__ = ["SPACE", "SPACES", "attach", "count_words", "let", "stored", "table", "words_of"]

#: A word is a longest run of characters outside this class.
SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text; none of a null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def attach(rows: DataFrame, few: DataFrame, key: str, other: str, spread: str, salts: int = 16) -> DataFrame:
    """Left join of rows whose keys may be hot with a table of few rows per key; nulls meet.

    The rows of a hot key meet their match in ``salts`` tasks, dealt by
    ``spread``. The tables are merged, whatever their size: Spark judges ``few``
    by its size on disk, packed and without the salts, and a broadcast of it
    would take the driver many times that.
    """
    many = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    own = rows.withColumn("_own_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    meet = own[key].eqNullSafe(many[other]) & (own["_own_salt"] == many["_salt"])
    return own.join(many.hint("merge"), meet, "left").drop("_salt", "_own_salt")
