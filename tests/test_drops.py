"""Drop hours against a plain fold."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from cellpulse.operators import drops

START = datetime(2024, 1, 1)


def spine_of(spark, cells):
    rows = [(c, START + timedelta(hours=i), v) for c, values in cells.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "grid_id string, timestamp timestamp, total_activity double").repartition(3)


def plain(values, allowance="0.5", limit=6):
    six = lambda x: Decimal(repr(round(x, 12))).quantize(Decimal("0.000001"), ROUND_HALF_UP)
    score, found = Decimal(0), {}
    for i, v in enumerate(values):
        own = values[i % 24 :: 24]
        usual = float(six(sum(own) / len(own)))
        short = six(1 - v / usual) - Decimal(allowance) if usual else Decimal(0)
        score = max(Decimal(0), score + short)
        if score >= limit:
            found[START + timedelta(hours=i)] = float(score)
    return found


def test_against_a_plain_fold(spark):
    draw = random.Random(2)
    cells = {}
    for c in "abcdef":
        values = [draw.choice([0.0, 8.0, 10.0, 12.5]) for _ in range(24 * 12)]
        for _ in range(2):
            at = draw.randrange(200)
            values[at : at + 30] = [0.0] * 30
        cells[c] = values
    cells["silent"] = [0.0] * 48
    found = drops.drop_hours(spine_of(spark, cells)).collect()
    got = {c: {r["timestamp"]: r["drop_score"] for r in found if r["grid_id"] == c} for c in cells}
    assert got == {c: plain(v) for c, v in cells.items()}
    assert got["silent"] == {} and any(got.values())


def test_episodes_are_hours_in_a_row(spark):
    values = [10.0] * 24 * 8
    values[24:44], values[100:120] = [0.0] * 20, [0.0] * 20
    hours = drops.drop_hours(spine_of(spark, {"a": values, "b": [5.0] * 48}))
    episodes = sorted(drops.drop_episodes(hours).collect(), key=lambda r: r["start_time"])
    assert [(r["grid_id"], r["start_time"] >= START + timedelta(hours=24)) for r in episodes] == [("a", True), ("a", True)]
    expected = plain(values)
    assert sum(r["n_hours"] for r in episodes) == len(expected)
    for r in episodes:
        assert r["end_time"] - r["start_time"] == timedelta(hours=r["n_hours"] - 1)
        assert r["depth"] == max(v for t, v in expected.items() if r["start_time"] <= t <= r["end_time"])


def test_empty_spine(spark):
    assert drops.drop_episodes(drops.drop_hours(spine_of(spark, {}))).count() == 0
