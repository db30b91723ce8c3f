"""As-of joins against a search per event, and sketches against exact values."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from cellpulse.operators import asof, sketches

START = datetime(2024, 1, 1)


def test_last_state_against_a_search(spark):
    draw = random.Random(4)
    at = lambda: START + timedelta(hours=draw.randrange(24 * 9))
    states = [(draw.choice(["hot", "hot", "a", "b", None]), draw.choice([at(), at(), None]), draw.randrange(50), "x") for _ in range(300)]
    states += states[:5]
    events = [(i, draw.choice(["hot", "hot", "hot", "a", "b", "c", None]), draw.choice([at(), at(), at(), None])) for i in range(400)]
    events += [events[0], (900, "hot", states[0][1] or START), (901, "a", START - timedelta(days=3))]
    left = spark.createDataFrame(events, "level long, grid_id string, timestamp timestamp")
    right = spark.createDataFrame(states, "grid_id string, timestamp timestamp, score int, note string")
    found = asof.last_state(left, right, carried=("score", "note"))
    assert found.columns == ["level", "grid_id", "timestamp", "state_time", "score", "note"]
    expected = []
    for e in events:
        fit = [(t, score, note) for k, t, score, note in states if None not in (k, t, e[1], e[2]) and k == e[1] and t <= e[2]]
        expected.append((*e, *max(fit, default=(None, None, None))))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_as_of_needs_no_range_join_and_takes_empty_tables(spark):
    left = spark.createDataFrame([("a", START)], "grid_id string, timestamp timestamp")
    right = spark.createDataFrame([], "grid_id string, timestamp timestamp, score int")
    found = asof.last_state(left, right, carried=("score",))
    assert [tuple(r) for r in found.collect()] == [("a", START, None, None)]
    assert asof.last_state(left.limit(0), right, carried=("score",)).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def hourly_of(spark, days, cells):
    draw = random.Random(6)
    rows = [(date(2024, 1, 1) + timedelta(days=d), f"c{draw.randrange(cells)}", draw.expovariate(0.1)) for d in range(days) for _ in range(2000)]
    return rows, spark.createDataFrame(rows, "date date, grid_id string, total_activity double")


def test_merged_distinct_counts(spark):
    rows, hourly = hourly_of(spark, 12, 20_000)
    daily = sketches.cell_sketches(hourly)
    exact = {d: len({c for x, c, _ in rows if x == d}) for d, _, _ in rows}
    assert {r["date"]: r["active_cells"] for r in daily.collect()} == exact
    whole = sketches.active_cells(daily, F.lit("all")).first()["active_cells"]
    true = len({c for _, c, _ in rows})
    assert abs(whole - true) <= 0.05 * true


def test_merged_quantiles_stay_within_the_rank_error(spark):
    rows, hourly = hourly_of(spark, 10, 50)
    hourly = hourly.withColumn("kind", F.lit("k"))
    found = sketches.activity_quantiles(sketches.activity_sketches(hourly, ["kind"]), ["kind"]).first()
    values = sorted(v for _, _, v in rows)
    assert found["n_rows"] == len(values)
    for share, name in ((0.5, "p50"), (0.9, "p90")):
        rank = sum(v <= found[name] for v in values) / len(values)
        assert abs(rank - share) <= sketches.RANK_ERROR
