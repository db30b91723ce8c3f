"""Activity input derived from an event log: raw rows, landing files, cell geometry.

The event log has (ts, user_id, event_type, value, props). A user stands for a
cell, an event type for one of the five measures, and the number ``k`` in props
for the country code. Certain values of ``k`` in certain weeks bring the faults
that the gates have to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpulse.schemas import RAW_COLUMNS
from cellpulse.session import scratch_path
from cellpulse.sources.landing import NAME_PREFIX

# Event type -> raw measure.
MEASURE_OF_EVENT = {
    "click": "smsin",
    "view": "smsout",
    "purchase": "callin",
    "signup": "callout",
    "error": "internet",
}

# Which k carries which fault, and on which days of the month.
K_NO_CELL = 97
K_BAD_TIME, BAD_TIME_DAYS = 13, (1, 5)
K_NEGATIVE, NEGATIVE_DAYS = 89, (6, 10)
K_NOT_A_NUMBER_TEXT = 83
K_NAN_TEXT = 79
K_INFINITY_TEXT = 71
SHORT_DAY = 27  # hour 5 is recorded as hour 6: 23 distinct times
LATE_DAY = 28  # hour 0 is recorded under the day before
REORDERED_DAY = 29  # columns in another order, one more column
NARROW_DAY = 30  # no internet column
RESENT_DAY = 2  # sent again under another name, where a landing asks for it

# Nations of suppliers whose cells are special.
NATION_NO_ID, NATION_TWICE, NATION_TWO_AREAS, NATION_POINT = 7, 3, 5, 11

_landings: dict[tuple[str, str], str] = {}


def _between(day: Column, span: tuple[int, int]) -> Column:
    return day.between(*span)


def activity_rows(events: DataFrame) -> DataFrame:
    """Raw activity rows as text, in the layout of a daily file, with the delivery name."""
    # Going through a generator, the values below are computed once per row and
    # not again in each expression that uses them.
    facts = F.struct(
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.day("ts").alias("day"),
        F.date_trunc("hour", "ts").alias("hour_start"),
    )
    events = events.select("ts", "user_id", "event_type", "value", F.inline(F.array(facts)))
    k, day, hour_start = F.col("k"), F.col("day"), F.col("hour_start")
    recorded = (
        F.when((day == SHORT_DAY) & (F.hour("ts") == 5), hour_start + F.expr("INTERVAL 1 HOUR"))
        .when((day == LATE_DAY) & (F.hour("ts") == 0), hour_start - F.expr("INTERVAL 1 DAY"))
        .otherwise(hour_start)
    )
    bad_time = (k == K_BAD_TIME) & _between(day, BAD_TIME_DAYS)
    negative = (k == K_NEGATIVE) & _between(day, NEGATIVE_DAYS)
    value = (
        F.when(k == K_NOT_A_NUMBER_TEXT, "abc")
        .when(k == K_NAN_TEXT, "NaN")
        .when(k == K_INFINITY_TEXT, "Infinity")
        .when(negative, (-F.col("value")).cast("string"))
        .otherwise(F.col("value").cast("string"))
    )
    measures = [
        F.when(F.col("event_type") == event, value).alias(name)
        for event, name in MEASURE_OF_EVENT.items()
    ]
    row = F.struct(
        F.when(bad_time, "bad").otherwise(F.date_format(recorded, "yyyy-MM-dd HH:mm:ss")).alias("datetime"),
        F.when(k != K_NO_CELL, F.col("user_id").cast("string")).alias("CellID"),
        k.cast("string").alias("countrycode"),
        *measures,
        F.concat(F.lit(NAME_PREFIX), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv")).alias("_source_file"),
    )
    return events.select(F.inline(F.array(row)))


def read_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_rows(spark.read.parquet(f"{sf_dir}/events.parquet"))


def write_landing(rows: DataFrame, folder: str, plain: bool = False) -> None:
    """Write raw rows as CSV deliveries, one folder of part files per day.

    Two days come with other layouts, unless ``plain``.

    The rebalance hint gathers each delivery; adaptive execution splits a large
    one over several part files.
    """
    named = rows.withColumnRenamed("_source_file", "delivery")
    day = F.substring("delivery", len(NAME_PREFIX) + 9, 2).cast("int")
    reordered = ["CellID", "datetime", *RAW_COLUMNS[2:], "note"]
    layouts = [(F.lit(True), list(RAW_COLUMNS))] if plain else [
        (~day.isin(REORDERED_DAY, NARROW_DAY), list(RAW_COLUMNS)),
        (day == REORDERED_DAY, reordered),
        (day == NARROW_DAY, [c for c in RAW_COLUMNS if c != "internet"]),
    ]
    for condition, columns in layouts:
        (
            named.where(condition)
            .withColumn("note", F.lit("x"))
            .select("delivery", *columns)
            .hint("rebalance", "delivery")
            .write.mode("append")
            .partitionBy("delivery")
            .option("header", True)
            .csv(folder)
        )


def landing_of(spark: SparkSession, sf_dir: str, plain: bool = False, resent: bool = False) -> str:
    """Landing folder with the deliveries of an event table, written once per session."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}#{'plain' if plain else 'mixed'}{'+' * resent}")
    if key not in _landings:
        folder = scratch_path(spark, "landing")
        rows = read_activity(spark, sf_dir)
        if resent:
            again = rows.where(F.col("_source_file").endswith(f"-{RESENT_DAY:02d}.csv"))
            renamed = F.concat(F.lit(NAME_PREFIX), F.lit(f"again-{RESENT_DAY:02d}.csv"))
            rows = rows.unionByName(again.withColumn("_source_file", renamed))
        write_landing(rows, folder, plain)
        _landings[key] = folder
    return _landings[key]


def cell_collections(suppliers: DataFrame) -> DataFrame:
    """Feature collections as lines of text, one per supplier: a unit square each.

    Some have two squares, a point, no id, no geometry, or the same feature twice.
    """
    x, y, nation = F.col("s_suppkey").cast("double"), F.col("s_nationkey").cast("double"), F.col("s_nationkey")
    corners = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]

    def polygon(offset: float) -> Column:
        return F.array(F.array(*[F.array(x + offset + dx, y + dy) for dx, dy in corners]))

    def shape(kind: str, coordinates: Column) -> Column:
        return F.to_json(F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")))

    geometry = (
        F.when(F.col("s_acctbal") < 0, F.lit("null"))
        .when(nation == NATION_TWO_AREAS, shape("MultiPolygon", F.array(polygon(0.0), polygon(2.0))))
        .when(nation == NATION_POINT, shape("Point", F.array(x, y)))
        .otherwise(shape("Polygon", polygon(0.0)))
    )
    properties = F.when(nation != NATION_NO_ID, F.concat(F.lit('{"cellId":'), F.col("s_suppkey"), F.lit("}"))).otherwise("{}")
    feature = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}"))
    copies = F.when(nation == NATION_TWICE, 2).otherwise(1)
    features = F.array_join(F.array_repeat(feature, copies), ",")
    return suppliers.select(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), features, F.lit("]}")).alias("value")
    )


def area_collections(suppliers: DataFrame) -> DataFrame:
    """Feature collections as lines of text: areas that overlap, by turns a square with a hole, a triangle and two squares.

    Their places and sizes follow the supplier's number; every 40th area is thirty times as large as the others.
    """
    key = F.col("s_suppkey")
    x, y = (key * 7 % 120).cast("double"), (key * 3 % 30).cast("double")
    side = F.when(key % 40 == 0, 60.0).otherwise(2.0)

    def ring(points: list[tuple[float, float]], dx: Column, dy: Column, size: Column) -> Column:
        return F.array(*[F.array(dx + px * size, dy + py * size) for px, py in [*points, points[0]]])

    square, triangle = [(0, 0), (1, 0), (1, 1), (0, 1)], [(0, 0), (1, 0), (0, 1)]
    hole = ring(square, x + side / 2, y + side / 2, side / 2)
    shape = lambda kind, c: F.to_json(F.struct(F.lit(kind).alias("type"), c.alias("coordinates")))
    geometry = (
        F.when(key % 3 == 0, shape("Polygon", F.array(ring(square, x, y, side), hole)))
        .when(key % 3 == 1, shape("Polygon", F.array(ring(triangle, x, y, side))))
        .otherwise(shape("MultiPolygon", F.array(F.array(ring(square, x, y, side)), F.array(ring(square, x + 2 * side, y, side)))))
    )
    feature = F.concat(F.lit('{"type":"Feature","properties":{"cellId":'), key, F.lit('},"geometry":'), geometry, F.lit("}"))
    return suppliers.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), feature, F.lit("]}")).alias("value"))


def lattice_collections(suppliers: DataFrame, width: int = 10) -> DataFrame:
    """Feature collections as lines of text: unit squares side by side in rows of ``width``, every second one drawn backwards."""
    key = F.col("s_suppkey")
    x, y = (key % width).cast("double"), F.floor(key / width).cast("double")
    corners = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    ring = F.array(*[F.array(x + dx, y + dy) for dx, dy in corners])
    ring = F.when(key % 2 == 0, F.reverse(ring)).otherwise(ring)
    geometry = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))
    feature = F.concat(F.lit('{"type":"Feature","properties":{"cellId":'), key, F.lit('},"geometry":'), geometry, F.lit("}"))
    return suppliers.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), feature, F.lit("]}")).alias("value"))


def read_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cell_collections(spark.read.parquet(f"{sf_dir}/supplier.parquet"))


def geojson_of(spark: SparkSession, sf_dir: str) -> str:
    """Folder of GeoJSON, one collection per line, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir + "#cells")
    if key not in _landings:
        folder = scratch_path(spark, "cells")
        read_cells(spark, sf_dir).write.text(folder)
        _landings[key] = folder
    return _landings[key]
