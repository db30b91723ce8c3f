"""Clusters of hotspots against a plain search over neighbours."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from cellpulse.operators import clusters
from cellpulse.schemas import AREA_TYPE

START = datetime(2024, 1, 1)


def lattice(spark, width, height):
    def ring(x, y):
        r = [[x, y], [x + 1.0, y], [x + 1.0, y + 1.0], [x, y + 1.0], [x, y]]
        return r if (x + y) % 2 else r[::-1]

    rows = [(f"c{x}-{y}", ("MultiPolygon", [[ring(float(x), float(y))]])) for x in range(width) for y in range(height)]
    return spark.createDataFrame([*rows, ("none", None)], f"grid_id string, geometry {AREA_TYPE}")


def test_against_a_search(spark):
    draw = random.Random(5)
    hot = {(START + timedelta(hours=h), x, y): float(draw.randrange(1, 99)) for h in range(4) for x in range(12) for y in range(12) if draw.random() < 0.45}
    hot |= {(START + timedelta(hours=9), x, 0): 1.0 for x in range(12)}  # a chain
    rows = [(t, f"c{x}-{y}", v, True) for (t, x, y), v in hot.items()] + [(START, "none", 5.0, True), (START, "c0-0x", 5.0, True)]
    rows += [(t, f"c{x}-{y}", 3.0, False) for t in {k[0] for k in hot} for x in range(12) for y in range(12) if (t, x, y) not in hot]
    spots = spark.createDataFrame(rows, "timestamp timestamp, grid_id string, total_activity double, hotspot_flag boolean")
    found = clusters.hotspot_clusters(spots, lattice(spark, 12, 12)).collect()
    expected, left = [], set(hot)
    while left:
        todo, own = [left.pop()], []
        while todo:
            t, x, y = todo.pop()
            own.append((t, x, y))
            for near in ((t, x + 1, y), (t, x - 1, y), (t, x, y + 1), (t, x, y - 1)):
                if near in left:
                    left.remove(near)
                    todo.append(near)
        values = [hot[k] for k in own]
        xs, ys = [x for _, x, _ in own], [y for _, _, y in own]
        expected.append((own[0][0], min(f"c{x}-{y}" for _, x, y in own), len(own), max(values), sum(values), min(xs), min(ys), max(xs) + 1, max(ys) + 1))
    assert sorted(map(tuple, found)) == sorted(expected)
    assert max(r["n_cells"] for r in found) >= 12


def test_no_hotspots(spark):
    spots = spark.createDataFrame([], "timestamp timestamp, grid_id string, total_activity double, hotspot_flag boolean")
    assert clusters.hotspot_clusters(spots, lattice(spark, 2, 2)).count() == 0
