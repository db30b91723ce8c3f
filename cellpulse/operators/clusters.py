"""Hotspots that touch: cells that share an edge and are hot in the same hour form one cluster.

Two cells are neighbours if a ring of each has the same edge, whatever its
direction. Edges are compared by a hash of their corners, so neighbours meet by an
equi-join; nobody compares polygons. Among the cells that are hot in an hour and share an edge, each is
linked to the smallest, and labels spread along these links until they settle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellpulse.operators.geo import grid_centroids
from cellpulse.session import discard, stored

#: Digits of a coordinate in which corners of neighbours must agree.
DIGITS = 9


def cell_edges(lookup: DataFrame, digits: int = DIGITS) -> DataFrame:
    """``grid_id`` and ``edge`` (a hash) for every edge of every ring; edges without length are left out."""
    rings = lookup.select("grid_id", F.explode(F.flatten("geometry.coordinates")).alias("ring"))
    # -0.0 becomes 0.0 by the addition.
    corner = lambda p: F.concat_ws(",", *[(F.round(p[k], digits) + F.lit(0.0)).cast("string") for k in (0, 1)])
    corners = rings.select("grid_id", F.transform("ring", corner).alias("c"))
    following = F.concat(F.slice("c", F.lit(2), F.size("c")), F.slice("c", 1, 1))
    edges = corners.select("grid_id", F.explode(F.arrays_zip(F.col("c").alias("a"), following.alias("b"))).alias("e"))
    edges = edges.where("e.a != e.b")
    both = F.xxhash64(F.least("e.a", "e.b"), F.greatest("e.a", "e.b"))
    return edges.select("grid_id", both.alias("edge")).distinct()


def spread_labels(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node that links lead to, for all nodes of ``links`` (``a``, ``b``).

    A node takes the smallest label of its neighbours, and then the label of that
    label's own node, which doubles the reach of each round.
    """
    ways = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "ways")
    labels = stored(ways.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        near = ways.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("lower"))
        lower = stored(lower, "lower")
        ends = lower.select(F.col("node").alias("lower"), F.col("lower").alias("end"))
        moved = lower.join(ends, "lower", "left").select("node", F.least("lower", F.coalesce("end", "lower")).alias("label"), F.col("label").alias("was"))
        moved = stored(moved, "labels")
        discard(labels, lower)
        labels = moved.select("node", "label")
        if moved.where("label != was").isEmpty():
            discard(ways)
            return labels


def hotspot_clusters(hotspots: DataFrame, lookup: DataFrame) -> DataFrame:
    """One row per cluster and hour: its smallest cell, size, peak and total activity, and extent.

    Hot cells without an area are left out; a hot cell without hot neighbours is a cluster of one.
    """
    boxes = stored(grid_centroids(lookup), "boxes")
    hot = hotspots.where("hotspot_flag").select("timestamp", "grid_id", "total_activity")
    hot = stored(hot.join(boxes.select("grid_id", "min_x", "min_y", "max_x", "max_y"), "grid_id"), "hot")
    edges = hot.select("timestamp", "grid_id").join(cell_edges(lookup), "grid_id")
    smallest = edges.groupBy("timestamp", "edge").agg(F.min("grid_id").alias("first"), F.max("grid_id").alias("last")).where("first < last")
    links = edges.join(smallest, ["timestamp", "edge"]).where("grid_id != first")
    node = lambda c: F.struct("timestamp", F.col(c).alias("grid_id"))
    labels = spread_labels(links.select(node("grid_id").alias("a"), node("first").alias("b")))
    labels = labels.select("node.timestamp", "node.grid_id", F.col("label.grid_id").alias("label"))
    placed = hot.join(labels, ["timestamp", "grid_id"], "left").withColumn("cluster", F.coalesce("label", "grid_id"))
    return placed.groupBy("timestamp", "cluster").agg(
        F.count("*").alias("n_cells"),
        F.max("total_activity").alias("peak_activity"),
        F.sum("total_activity").alias("total_activity"),
        F.min("min_x").alias("min_x"),
        F.min("min_y").alias("min_y"),
        F.max("max_x").alias("max_x"),
        F.max("max_y").alias("max_y"),
    )
