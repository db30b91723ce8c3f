"""Joins of activity with cell geometry, and what they leave unmatched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpulse.functions.measures import percent


def enrich_with_geometry(activity: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join on grid_id. The lookup is unique per id, so the row count stays the same."""
    return activity.join(lookup.select("grid_id", "geometry"), "grid_id", "left")


def _cause() -> Column:
    """Why a cell that was looked up has no area; null if it has one."""
    return (
        F.when(F.col("no_area").isNull(), "no feature")
        .when(F.col("other_kind").isNotNull(), "geometry of another kind")
        .when(F.col("no_area"), "feature without geometry")
    )


def _looked_up(activity: DataFrame, lookup: DataFrame) -> DataFrame:
    known = lookup.select("grid_id", "other_kind", F.col("geometry").isNull().alias("no_area"))
    return activity.select("grid_id").distinct().join(known, "grid_id", "left")


def unmatched_grids(activity: DataFrame, lookup: DataFrame) -> DataFrame:
    """Active cells without an area, and why: no feature, one without geometry, or one of another kind."""
    return _looked_up(activity, lookup).select("grid_id", _cause().alias("reason")).where("reason is not null")


def silent_grids(activity: DataFrame, lookup: DataFrame) -> DataFrame:
    """Cells of the lookup that have no activity at all."""
    active = activity.select("grid_id").distinct()
    return lookup.select("grid_id").join(active, "grid_id", "left_anti")


def geo_coverage(activity: DataFrame, lookup: DataFrame) -> DataFrame:
    """One row: active cells, cells without geometry by cause, and coverage in percent."""
    cause = _cause()
    counts = _looked_up(activity, lookup).agg(
        F.count("*").alias("activity_grids"),
        F.count_if(cause == "no feature").alias("grids_without_feature"),
        F.count_if(cause == "feature without geometry").alias("grids_without_geometry"),
        F.count_if(cause == "geometry of another kind").alias("grids_of_other_kind"),
    )
    missing = F.col("grids_without_feature") + F.col("grids_without_geometry") + F.col("grids_of_other_kind")
    return counts.select(
        "*",
        missing.alias("missing_geometry_grids"),
        percent(F.col("activity_grids") - missing, F.col("activity_grids")).alias("coverage_percentage"),
    )


def _ring_moments(ring: Column) -> Column:
    """Twice the area of a ring, and six times its first moments, as positive for either direction."""
    # Each point with the next, the last with the first: in a closed ring that edge adds nothing.
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))

    def edge(a: Column, b: Column) -> Column:
        cross = a[0] * b[1] - b[0] * a[1]
        return F.struct(cross.alias("area"), (cross * (a[0] + b[0])).alias("x"), (cross * (a[1] + b[1])).alias("y"))

    def add(total: Column, e: Column) -> Column:
        return F.struct(*[(total[c] + e[c]).alias(c) for c in ("area", "x", "y")])

    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("area", "x", "y")])
    positive = lambda m: F.struct(*[(m[c] * F.signum(m["area"])).alias(c) for c in ("area", "x", "y")])
    return F.aggregate(F.zip_with(ring, following, edge), zero, add, positive)


def grid_centroids(lookup: DataFrame) -> DataFrame:
    """Bounding box of all rings, and area centroid of the outer rings, per cell with an area.

    Polygons of one cell weigh by their areas, whatever the direction of their
    rings; without any area the centroid is the mean of the points.
    """
    shapes = lookup.where(F.size(F.flatten(F.flatten("geometry.coordinates"))) > 0)
    points = F.flatten(F.flatten("geometry.coordinates"))
    outer = F.transform("geometry.coordinates", lambda polygon: F.get(polygon, F.lit(0)))
    moments = F.transform(F.filter("outer", lambda r: r.isNotNull()), _ring_moments)
    total = lambda c: F.aggregate("moments", F.lit(0.0), lambda t, m: t + m[c])
    ring_points = F.flatten(F.filter("outer", lambda r: r.isNotNull()))
    mean = lambda k: F.aggregate(ring_points, F.lit(0.0), lambda t, p: t + p[k]) / F.size(ring_points)
    along = lambda k: F.transform(points, lambda p: p[k])
    boxed = shapes.select(
        "grid_id",
        F.array_min(along(0)).alias("min_x"),
        F.array_min(along(1)).alias("min_y"),
        F.array_max(along(0)).alias("max_x"),
        F.array_max(along(1)).alias("max_y"),
        outer.alias("outer"),
    ).withColumn("moments", moments)
    area3 = total("area") * 3.0
    return boxed.select(
        "grid_id",
        F.when(area3 != 0, total("x") / area3).otherwise(mean(0)).alias("centroid_x"),
        F.when(area3 != 0, total("y") / area3).otherwise(mean(1)).alias("centroid_y"),
        "min_x",
        "min_y",
        "max_x",
        "max_y",
    )
