"""Points in cells against a ray-crossing test over all pairs."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from cellpulse.operators import spatial
from cellpulse.schemas import AREA_TYPE


def lookup_of(spark, cells):
    kind = AREA_TYPE
    rows = [(k, None if c is None else ("MultiPolygon", c)) for k, c in cells.items()]
    return spark.createDataFrame(rows, f"grid_id string, geometry {kind}")


def plain(x, y, polygons):
    for rings in polygons:
        odd = False
        for ring in rings:
            for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
                if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                    odd = not odd
        if odd:
            return True
    return False


def ring(x, y, size, n, draw):
    """A star-shaped ring around a place."""
    import math

    angles = sorted(draw.random() * 2 * math.pi for _ in range(n))
    points = [[x + size * (0.3 + draw.random()) * math.cos(a), y + size * (0.3 + draw.random()) * math.sin(a)] for a in angles]
    return [*points, points[0]]


def test_random_areas_against_all_pairs(spark):
    draw = random.Random(8)
    cells = {"none": None, "empty": []}
    for i in range(40):
        size = draw.choice([0.2, 1.0, 3.0, 40.0])
        x, y = draw.uniform(-20, 20), draw.uniform(-20, 20)
        parts = [[ring(x + 2 * size * p, y, size, draw.randrange(3, 9), draw)] for p in range(draw.choice([1, 1, 2]))]
        if i % 4 == 0:
            parts[0].append(ring(x, y, size / 5, 5, draw))
        cells[f"c{i}"] = parts
    points = [(i, draw.uniform(-30, 30), draw.uniform(-30, 30)) for i in range(400)]
    points += [(900, None, 1.0), (901, 1.0, None), points[0], (902, points[0][1], points[0][2])]
    found = spatial.locate(spark.createDataFrame(points, "px long, x double, y double"), lookup_of(spark, cells))
    assert found.columns == ["px", "x", "y", "grid_id"]
    expected = []
    for p in points:
        own = [k for k, c in cells.items() if c and p[1] is not None and p[2] is not None and plain(p[1], p[2], c)]
        expected += [(*p, k) for k in own or [None]]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_cells_that_share_an_edge_share_no_point(spark):
    square = lambda x, y: [[[[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]]]
    cells = {f"{x}{y}": square(float(x), float(y)) for x in range(3) for y in range(3)}
    points = [(x / 2, y / 2) for x in range(7) for y in range(7)]
    found = spatial.locate(spark.createDataFrame(points, "x double, y double"), lookup_of(spark, cells))
    inside = found.where("grid_id is not null")
    assert inside.count() == inside.select("x", "y").distinct().count() == 36
    assert found.count() == len(points)


def test_at_most_four_tiles_and_an_equi_join(spark):
    wide = [[[[0.0, 0.0], [1000.0, 0.0], [1000.0, 3.0], [0.0, 3.0], [0.0, 0.0]]]]
    tiles = spatial.cell_tiles(lookup_of(spark, {"a": wide, "b": [[[[0.1, 0.1], [0.2, 0.1], [0.1, 0.2], [0.1, 0.1]]]]}))
    assert tiles.groupBy("grid_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] <= 4
    points = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
    plan = spatial.locate(points, lookup_of(spark, {"a": wide}))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_no_cells_and_no_points(spark):
    points = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
    assert spatial.locate(points, lookup_of(spark, {})).collect() == [(1.0, 1.0, None)]
    assert spatial.locate(points.limit(0), lookup_of(spark, {"a": [[[[0.0, 0.0], [1.0, 0.0], [0.0, 1.0]]]]})).count() == 0


def test_totals_locate_each_place_once(spark, monkeypatch):
    """Totals by cell against all pairs; copies of a place are summed up before the cells are looked for."""
    square = lambda x, size: [[[[x, 0.0], [x + size, 0.0], [x + size, size], [x, size], [x, 0.0]]]]
    cells = {"a": square(0.0, 1.0), "b": square(0.0, 4.0), "c": square(3.0, 1.0), "far": square(50.0, 1.0)}
    places = [(0.5, 0.5), (3.5, 0.5), (9.0, 9.0), (None, 0.5)]
    points = [(*places[i % 4], None if i % 7 == 0 else float(i)) for i in range(200)] + [(3.2, 3.2, None)]
    located, rows = spatial.locate, []

    def watched(found, *args, **kwargs):
        rows.append(found.count())
        return located(found, *args, **kwargs)

    monkeypatch.setattr(spatial, "locate", watched)
    frame = spark.createDataFrame(points, "x double, y double, value double")
    found = {r["grid_id"]: (r["n_points"], r["total_value"]) for r in spatial.totals_by_cell(frame, lookup_of(spark, cells), "value").collect()}
    expected = {}
    for x, y, value in points:
        for k in [k for k, c in cells.items() if x is not None and plain(x, y, c)] or [None]:
            expected.setdefault(k, []).append(value)
    assert found == {k: (len(v), sum(x for x in v if x is not None)) for k, v in expected.items()}
    assert rows == [5]
