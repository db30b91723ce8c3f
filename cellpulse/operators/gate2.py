"""Gate 2: is the processed data trustworthy enough to publish?

Every check is one row (check_name, passed, observed, expected). Checks over the
hourly table share one cascade of aggregations, each on the result of the one
before, so the table is read once.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpulse.functions.measures import percent
from cellpulse.schemas import MEASURES

EQUAL, AT_LEAST, AT_MOST = "equal", "at least", "at most"
GRID_ID_PATTERN = "^[0-9]+$"
#: Limits in percent: reference cells that are active, active cells that the
#: reference lacks, and grid-hours that have a baseline.
MIN_REPRESENTED, MAX_UNKNOWN, MIN_COMPUTABLE = 50.0, 50.0, 50.0


def _as_rows(facts: DataFrame, checks: list[tuple[str, Column, str, Column]]) -> DataFrame:
    """One row per check from a one-row frame of facts."""
    entries = []
    for name, observed, rule, expected in checks:
        o, e = observed.cast("double"), expected.cast("double")
        held = {EQUAL: o == e, AT_LEAST: o >= e, AT_MOST: o <= e}[rule]
        entries.append(
            F.struct(
                F.lit(name).alias("check_name"),
                F.coalesce(held, F.lit(False)).alias("passed"),
                o.alias("observed"),
                e.alias("expected"),
            )
        )
    return facts.select(F.inline(F.array(*entries)))


def _flagged(condition: Column, weight: str = "n") -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0))


def hourly_checks(hourly: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Dates, hours, valid ids, null or negative or NaN measures, valid times, unique grain."""
    any_null = F.lit(False)
    any_negative = F.lit(False)
    any_nan = F.lit(False)
    for m in MEASURES:
        any_null = any_null | F.col(m).isNull()
        any_negative = any_negative | F.coalesce(F.col(m) < 0, F.lit(False))
    derived = ("total_sms", "total_calls", "total_activity", "internet_share")
    for m in (*MEASURES, *(c for c in derived if c in hourly.columns)):
        # Neither NaN nor infinite values are below infinity.
        any_nan = any_nan | ~F.coalesce(F.abs(m) < F.lit(float("inf")), F.lit(True))
    bad_id = F.col("grid_id").isNull() | ~F.col("grid_id").rlike(GRID_ID_PATTERN)
    cells = hourly.groupBy("timestamp", "grid_id").agg(
        F.count("*").alias("n"),
        F.count_if(any_null).alias("nulls"),
        F.count_if(any_negative).alias("negatives"),
        F.count_if(any_nan).alias("nans"),
    )
    sums = ["n", "nulls", "negatives", "nans", "bad_ids", "duplicates"]
    hours = (
        cells.withColumns(
            {"bad_ids": F.when(bad_id, F.col("n")).otherwise(0), "duplicates": F.col("n") - 1}
        )
        .groupBy("timestamp")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )
    on_the_hour = F.col("timestamp") == F.date_trunc("hour", "timestamp")
    days = (
        hours.withColumn("date", F.to_date("timestamp"))
        .groupBy("date")
        .agg(*[F.sum(c).alias(c) for c in sums], F.count_if(on_the_hour).alias("hours"))
    )
    day = F.col("date")
    after = day >= F.lit(start).cast("date") if start else day.isNotNull()
    before = day <= F.lit(end).cast("date") if end else day.isNotNull()
    facts = days.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        _flagged(F.col("date").isNull()).alias("bad_times"),
        (F.lit(start).cast("date") if start else F.min("date")).alias("first_date"),
        (F.lit(end).cast("date") if end else F.max("date")).alias("last_date"),
        F.count_if(after & before).alias("dates"),
        F.coalesce(F.sum(F.when(after & before, F.least("hours", F.lit(24)))), F.lit(0)).alias("hours"),
    )
    wanted = F.datediff("last_date", "first_date") + 1
    zero = F.lit(0)
    return _as_rows(
        facts,
        [
            ("expected_dates_present", F.col("dates"), EQUAL, wanted),
            ("hourly_intervals_present", F.col("hours"), AT_LEAST, wanted * 24),
            ("grid_id_valid", F.col("bad_ids"), EQUAL, zero),
            ("no_null_measures", F.col("nulls"), EQUAL, zero),
            ("no_negative_measures", F.col("negatives"), EQUAL, zero),
            ("measures_numeric", F.col("nans"), EQUAL, zero),
            ("timestamps_valid", F.col("bad_times"), EQUAL, zero),
            ("unique_grid_timestamp", F.col("duplicates"), EQUAL, zero),
        ],
    )


def grid_checks(
    hourly: DataFrame,
    lookup: DataFrame,
    min_represented: float = MIN_REPRESENTED,
    max_unknown: float = MAX_UNKNOWN,
) -> DataFrame:
    """Share of reference cells that are active, and of active cells that are not in the reference (percent)."""
    active = hourly.select("grid_id", F.lit(1).alias("is_active")).distinct()
    known = lookup.select("grid_id", F.lit(1).alias("is_known"))
    facts = active.join(known, "grid_id", "full").agg(
        F.count("is_active").alias("active"),
        F.count("is_known").alias("known"),
        F.count_if(F.col("is_active").isNotNull() & F.col("is_known").isNotNull()).alias("both"),
    )
    return _as_rows(
        facts,
        [
            ("grids_represented", percent(F.col("both"), F.col("known")), AT_LEAST, F.lit(min_represented)),
            (
                "grids_in_reference",
                percent(F.col("active") - F.col("both"), F.col("active")),
                AT_MOST,
                F.lit(max_unknown),
            ),
        ],
    )


def daily_check(daily: DataFrame) -> DataFrame:
    facts = daily.agg(F.count_if(F.col("daily_activity") < 0).alias("negative"))
    return _as_rows(facts, [("daily_totals_non_negative", F.col("negative"), EQUAL, F.lit(0))])


def baseline_checks(spots: DataFrame, alerts: DataFrame, min_computable: float = MIN_COMPUTABLE) -> DataFrame:
    """Share of grid-hours with a baseline (percent), and alerts whose denominator is not positive."""
    computable = spots.agg(
        F.count("*").alias("n"), F.count("baseline_activity").alias("with_baseline")
    )
    denominators = alerts.agg(
        F.count_if(F.col("baseline").isNull() | (F.col("baseline") <= 0)).alias("bad")
    )
    return _as_rows(
        computable,
        [
            (
                "baselines_computable",
                percent(F.col("with_baseline"), F.col("n")),
                AT_LEAST,
                F.lit(min_computable),
            )
        ],
    ).unionByName(
        _as_rows(denominators, [("alert_denominators_valid", F.col("bad"), EQUAL, F.lit(0))])
    )


def risk_check(scores: DataFrame) -> DataFrame:
    score = F.col("risk_score")
    facts = scores.agg(
        F.count_if(score.isNull() | F.isnan(score) | (score < 0) | (score > 1)).alias("outside")
    )
    return _as_rows(facts, [("risk_scores_in_bounds", F.col("outside"), EQUAL, F.lit(0))])


def reconcile(clean: DataFrame, hourly: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Each measure summed before and after the hourly aggregation; relative difference within tolerance."""
    before = clean.agg(*[F.coalesce(F.sum(m), F.lit(0.0)).alias(f"before_{m}") for m in MEASURES])
    after = hourly.agg(*[F.coalesce(F.sum(m), F.lit(0.0)).alias(f"after_{m}") for m in MEASURES])

    def tall(facts: DataFrame, prefix: str, name: str) -> DataFrame:
        entries = [
            F.struct(F.lit(m).alias("measure"), F.col(f"{prefix}_{m}").alias(name)) for m in MEASURES
        ]
        return facts.select(F.inline(F.array(*entries)))

    # Five rows on either side, one per measure.
    both = tall(before, "before", "clean_total").join(
        F.broadcast(tall(after, "after", "hourly_total")), "measure"
    )
    gap = F.abs(F.col("clean_total") - F.col("hourly_total"))
    scale = F.greatest(F.lit(1.0), F.abs("clean_total"))
    return both.withColumn("passed", gap <= scale * tolerance)


def reconcile_check(compared: DataFrame) -> DataFrame:
    facts = compared.agg(F.count_if(~F.col("passed")).alias("apart"))
    return _as_rows(facts, [("totals_reconcile", F.col("apart"), EQUAL, F.lit(0))])


def country_reconcile(clean: DataFrame, hourly: DataFrame) -> DataFrame:
    """Total activity and rows at each stage: source rows, country rows, grid-hours."""
    country = clean.groupBy("timestamp", "grid_id", "country_code").agg(
        F.sum("total_activity").alias("total_activity"), F.count("*").alias("n")
    )
    total = lambda: F.coalesce(F.sum("total_activity"), F.lit(0.0))
    rows = lambda number, grain, n: F.struct(
        F.lit(number).alias("stage"), F.lit(grain).alias("grain"), n.alias("row_count"), F.col("t").alias("total_activity")
    )
    # Source rows are counted on the way to the country rows, so the clean table is read once.
    first = country.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("source"), F.count("*").alias("rows"), total().alias("t"))
    both = F.array(rows(1, "source row", F.col("source")), rows(2, "grid, hour and country", F.col("rows")))
    last = hourly.agg(F.count("*").alias("rows"), total().alias("t"))
    return first.select(F.inline(both)).unionByName(
        last.select(F.inline(F.array(rows(3, "grid and hour", F.col("rows")))))
    )


def gate2_checks(
    hourly: DataFrame,
    daily: DataFrame,
    spots: DataFrame,
    alerts: DataFrame,
    lookup: DataFrame | None = None,
    compared: DataFrame | None = None,
    scores: DataFrame | None = None,
    start: date | None = None,
    end: date | None = None,
    min_represented: float = MIN_REPRESENTED,
    max_unknown: float = MAX_UNKNOWN,
    min_computable: float = MIN_COMPUTABLE,
) -> DataFrame:
    """All checks as rows. Publish only if every row has passed."""
    found = hourly_checks(hourly, start, end).unionByName(daily_check(daily))
    found = found.unionByName(baseline_checks(spots, alerts, min_computable))
    if lookup is not None:
        found = found.unionByName(grid_checks(hourly, lookup, min_represented, max_unknown))
    if compared is not None:
        found = found.unionByName(reconcile_check(compared))
    if scores is not None:
        found = found.unionByName(risk_check(scores))
    return found
