from __future__ import annotations

import pytest
from data import feature, square, write_geojson

from cellpulse.operators import geo
from cellpulse.session import stored
from cellpulse.sources.geojson import grid_lookup, read_geojson


@pytest.fixture(scope="module")
def lookup(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("reference") / "grid.geojson"
    features = [
        feature(1, square(0, 0)),
        feature(2, None),
        feature(None, square(5, 5)),
        feature(3, square(2, 3)),
        feature(3, square(2, 3)),
        feature(4, None),
        feature(4, square(7, 7)),
        feature(9, square(9, 9)),
    ]
    return grid_lookup(read_geojson(spark, write_geojson(path, features)))


@pytest.fixture(scope="module")
def hourly(spark):
    rows = [(g, float(i)) for i in range(3) for g in ("1", "2", "3", "4", "77")]
    return spark.createDataFrame(rows, "grid_id string, total_activity double")


def test_lookup_is_unique_and_prefers_a_geometry(lookup):
    rows = {r["grid_id"]: r["geometry"] for r in lookup.collect()}
    assert sorted(rows) == ["1", "2", "3", "4", "9"]
    assert rows["2"] is None and rows["4"]["coordinates"][0][0][0] == [7.0, 7.0]


def test_join_keeps_the_row_count(hourly, lookup):
    joined = geo.enrich_with_geometry(hourly, lookup)
    assert joined.count() == hourly.count()
    assert joined.where("grid_id = '77' and geometry is null").count() == 3


def test_unmatched_and_silent(hourly, lookup):
    found = {r["grid_id"]: r["reason"] for r in geo.unmatched_grids(hourly, lookup).collect()}
    assert found == {"2": "feature without geometry", "77": "no feature"}
    assert [r["grid_id"] for r in geo.silent_grids(hourly, lookup).collect()] == ["9"]


def test_coverage(hourly, lookup):
    row = geo.geo_coverage(hourly, lookup).first()
    assert (row["activity_grids"], row["missing_geometry_grids"]) == (5, 2)
    assert row["coverage_percentage"] == 60.0
    assert geo.geo_coverage(hourly.limit(0), lookup).first()["coverage_percentage"] == 0.0


def test_centroids(spark, lookup):
    rows = {r["grid_id"]: r for r in geo.grid_centroids(lookup).collect()}
    assert (rows["3"]["centroid_x"], rows["3"]["centroid_y"]) == (2.5, 3.5)
    assert (rows["3"]["min_x"], rows["3"]["max_y"]) == (2.0, 4.0)
    assert "2" not in rows


def test_centroid_is_weighted_by_area(spark, tmp_path):
    # A triangle with one edge split by many points: the mean of points would be off.
    ring = [[0.0, 0.0], [3.0, 0.0], [0.0, 3.0], [0.0, 2.0], [0.0, 1.0], [0.0, 0.0]]
    shapes = [
        feature(1, {"type": "Polygon", "coordinates": [ring]}),
        feature(2, {"type": "Polygon", "coordinates": [[[1.0, 1.0], [3.0, 1.0]]]}),
        feature(3, {"type": "Polygon", "coordinates": [[[1.0, 4.0]]]}),
    ]
    path = write_geojson(tmp_path / "g.geojson", shapes)
    rows = {r["grid_id"]: r for r in geo.grid_centroids(grid_lookup(read_geojson(spark, path))).collect()}
    assert (rows["1"]["centroid_x"], rows["1"]["centroid_y"]) == pytest.approx((1.0, 1.0))
    assert (rows["2"]["centroid_x"], rows["2"]["centroid_y"]) == (2.0, 1.0)
    assert (rows["3"]["centroid_x"], rows["3"]["centroid_y"]) == (1.0, 4.0)


def test_missing_reference(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_geojson(spark, str(tmp_path / "none.geojson"))


def test_lookup_is_broadcast_by_its_size_on_disk(spark, hourly, lookup):
    table = stored(lookup, "lookup")
    join = lambda: geo.enrich_with_geometry(hourly, table)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(join())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(join())
        assert join().count() == hourly.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_kinds_of_geometry(spark, tmp_path):
    two = {"type": "MultiPolygon", "coordinates": [square(0, 0)["coordinates"], square(2, 0)["coordinates"]]}
    turned = {"type": "MultiPolygon", "coordinates": [square(0, 0)["coordinates"], [square(2, 0)["coordinates"][0][::-1]]]}
    shapes = [
        feature(1, two),
        feature(2, {"type": "Point", "coordinates": [1.0, 2.0]}),
        feature(3, {"type": "Point", "coordinates": [1.0, 2.0]}),
        feature(3, square(5, 5)),
        feature(4, {"type": "Polygon", "coordinates": "broken"}),
        feature(5, turned),
    ]
    cells = grid_lookup(read_geojson(spark, write_geojson(tmp_path / "g.geojson", shapes)))
    rows = {r["grid_id"]: r for r in cells.collect()}
    assert rows["1"]["geometry"]["type"] == "MultiPolygon" and len(rows["1"]["geometry"]["coordinates"]) == 2
    assert rows["1"]["geometry"]["coordinates"][1][0][0] == [2.0, 0.0]
    assert rows["2"]["geometry"] is None and rows["2"]["other_kind"] == "Point"
    assert rows["3"]["geometry"]["type"] == "Polygon" and rows["3"]["other_kind"] is None
    assert rows["4"]["geometry"] is None
    centers = {r["grid_id"]: (r["centroid_x"], r["centroid_y"], r["max_x"]) for r in geo.grid_centroids(cells).collect()}
    assert centers["1"] == centers["5"] == (1.5, 0.5, 3.0) and "2" not in centers
    active = spark.createDataFrame([("1",), ("2",), ("9",)], "grid_id string")
    assert {r["grid_id"]: r["reason"] for r in geo.unmatched_grids(active, cells).collect()} == {
        "2": "geometry of another kind",
        "9": "no feature",
    }
    assert geo.geo_coverage(active, cells).first()["grids_of_other_kind"] == 1
