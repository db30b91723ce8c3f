"""Points to the cells they lie in, by an equi-join on tiles and a ray-crossing test.

A cell is entered in the tiles that its bounding box touches. Tiles come in
levels, each twice as wide as the one below, and a cell uses the level where a tile is at
least as long as its box, so it never has more than four entries, however
large it is. A point looks up one tile for each level that any cell uses.

A point lies in a cell if a ray to the right of it crosses the rings of one of the cell's
polygons an odd number of times, which takes holes out. Edges are half open, so of two
cells that share an edge one has the points on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Side of a tile of level 0; a power of two divides exactly at every level.
TILE = 1.0


def _crossings(ring: Column, x: Column, y: Column) -> Column:
    """How many edges of a ring a ray from (x, y) to the right crosses."""
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))

    def crossed(a: Column, b: Column) -> Column:
        spans = (a[1] > y) != (b[1] > y)
        at = a[0] + (y - a[1]) * (b[0] - a[0]) / F.nullif(b[1] - a[1], F.lit(0.0))
        return F.when(spans & (x < at), 1).otherwise(0)

    return F.aggregate(F.zip_with(ring, following, crossed), F.lit(0), lambda n, e: n + e)


def inside(geometry: Column, x: Column, y: Column) -> Column:
    """Whether a point lies in an area: a ``MultiPolygon`` as an array of polygons, each an array of rings."""
    odd = lambda polygon: F.aggregate(polygon, F.lit(0), lambda n, ring: n + _crossings(ring, x, y)) % 2 == 1
    return F.exists(geometry["coordinates"], odd)


def cell_tiles(lookup: DataFrame, tile: float = TILE) -> DataFrame:
    """One row for each tile that a cell's box touches, four at most: ``level``, ``tile_x``, ``tile_y``, ``grid_id``, ``geometry``."""
    points = F.flatten(F.flatten("geometry.coordinates"))
    along = lambda k: F.transform(points, lambda p: p[k])
    boxed = lookup.where(F.size(points) > 0).select(
        "grid_id",
        "geometry",
        *[f(along(k)).alias(n) for n, f, k in (
            ("x0", F.array_min, 0), ("x1", F.array_max, 0), ("y0", F.array_min, 1), ("y1", F.array_max, 1),
        )],
    )
    longest = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    level = F.when(longest > tile, F.ceil(F.log2(longest / tile))).otherwise(0).cast("int")
    boxed = boxed.withColumn("level", level).withColumn("side", tile * F.pow(F.lit(2.0), "level"))
    touched = lambda low, high: F.sequence(*[F.floor(F.col(c) / F.col("side")) for c in (low, high)])
    rows = boxed.withColumn("tile_x", F.explode(touched("x0", "x1"))).withColumn("tile_y", F.explode(touched("y0", "y1")))
    return rows.select("level", "tile_x", "tile_y", "grid_id", "geometry")


def locate(points: DataFrame, lookup: DataFrame, x: str = "x", y: str = "y", tile: float = TILE) -> DataFrame:
    """The rows of ``points`` with ``grid_id``: once for each cell they lie in, or once with null.

    Cells may overlap. Each distinct place is tested once, however many points
    it has. A point without coordinates lies in no cell.
    """
    tiles = cell_tiles(lookup, tile)
    levels = tiles.agg(F.collect_set("level").alias("levels")).scalar()
    places = points.select(F.col(f"`{x}`").cast("double").alias("px"), F.col(f"`{y}`").cast("double").alias("py")).distinct()
    places = places.where("px is not null and py is not null")
    side = tile * F.pow(F.lit(2.0), "level")
    keyed = places.select("px", "py", F.explode(levels).alias("level")).select(
        "px", "py", "level", F.floor(F.col("px") / side).alias("tile_x"), F.floor(F.col("py") / side).alias("tile_y")
    )
    looked = keyed.join(tiles, ["level", "tile_x", "tile_y"])
    found = looked.where(inside(F.col("geometry"), F.col("px"), F.col("py"))).select("px", "py", "grid_id")
    here = (points[f"`{x}`"].cast("double") == found["px"]) & (points[f"`{y}`"].cast("double") == found["py"])
    return points.join(found, here, "left").select(*[points[f"`{c}`"] for c in points.columns], found["grid_id"])


def totals_by_cell(points: DataFrame, lookup: DataFrame, value: str, x: str = "x", y: str = "y", tile: float = TILE) -> DataFrame:
    """``grid_id``, ``n_points`` and ``total_value`` of the points that lie in each cell; null for those that lie in none.

    Points of one place lie in the same cells, so they are summed up before they are located: where many
    cells overlap, no point is repeated for each of them. Places that hold one point each cost what ``locate`` does.
    """
    at = lambda c: F.col(f"`{c}`").cast("double")
    places = points.groupBy(at(x).alias("x"), at(y).alias("y")).agg(
        F.count("*").alias("n_points"), F.sum(F.col(f"`{value}`")).alias("total_value")
    )
    found = locate(places, lookup, tile=tile)
    return found.groupBy("grid_id").agg(F.sum("n_points").alias("n_points"), F.sum("total_value").alias("total_value"))
