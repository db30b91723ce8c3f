"""Summaries of a date that add up: distinct cells and distributions over any range, without reading its rows again.

Each date's rows are read once, when the date arrives, and its sketches are
stored by date. A longer range merges the sketches of its dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers of a distinct count are 2 ** LG_REGISTERS, so its standard error is 1.04 / 64.
LG_REGISTERS = 12
#: Size of a quantile sketch; its rank error is below RANK_ERROR.
QUANTILE_SIZE, RANK_ERROR = 400, 0.02


def cell_sketches(hourly: DataFrame) -> DataFrame:
    """One row per date: ``active_cells``, exact, and a sketch of the cells."""
    return hourly.groupBy("date").agg(
        F.count_distinct("grid_id").alias("active_cells"), F.hll_sketch_agg("grid_id", F.lit(LG_REGISTERS)).alias("cells")
    )


def active_cells(sketches: DataFrame, period: Column) -> DataFrame:
    """Estimated active cells of each period of dates, from their sketches."""
    return sketches.groupBy(period.alias("period")).agg(F.hll_sketch_estimate(F.hll_union_agg("cells")).alias("active_cells"))


def activity_sketches(hourly: DataFrame, keys: list[str]) -> DataFrame:
    """One sketch of the hourly activity per date and ``keys``."""
    sketch = F.kll_sketch_agg_double("total_activity", F.lit(QUANTILE_SIZE)).alias("activity")
    return hourly.groupBy("date", *keys).agg(sketch)


def activity_quantiles(sketches: DataFrame, keys: list[str], shares: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """Over all dates given: ``n_rows`` and the quantile of each share, per ``keys``."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("activity").alias("activity"))
    quantile = lambda p: F.kll_sketch_get_quantile_double("activity", F.lit(p)).alias(f"p{round(p * 100)}")
    return merged.select(*keys, F.kll_sketch_get_n_double("activity").alias("n_rows"), *[quantile(p) for p in shares])
