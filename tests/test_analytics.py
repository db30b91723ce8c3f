from __future__ import annotations

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cellpulse.operators import analytics, gate2, reports, risk

START = datetime(2024, 1, 1)
AT = datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def rows():
    """Sparse hours of six cells over nine days."""
    rng = random.Random(5)
    found = []
    for cell in range(6):
        for hour in range(9 * 24):
            if rng.random() < 0.6:
                value = round(rng.uniform(0, 20), 2) if rng.random() < 0.9 else 0.0
                found.append((START + timedelta(hours=hour), str(cell), value, round(value / 4, 2)))
    return found


@pytest.fixture(scope="module")
def hourly(spark, rows):
    schema = "timestamp timestamp, grid_id string, total_activity double, internet_activity double"
    return spark.createDataFrame(rows, schema).withColumn("date", F.to_date("timestamp"))


@pytest.fixture(scope="module")
def spots(hourly):
    return analytics.hotspots(analytics.grid_baseline(hourly))


def test_baseline_against_brute_force(rows, spots):
    found = {(r["grid_id"], r["timestamp"]): r for r in spots.collect()}
    assert len(found) == len(rows)
    for when, cell, value, _ in rows:
        same = [v for w, c, v, _ in rows if c == cell and w.hour == when.hour]
        others = [v for w, c, v, _ in rows if c == cell and w.hour == when.hour and w != when]
        row = found[(cell, when)]
        if not others:
            assert row["baseline_activity"] is None and row["hotspot_flag"] is False
            continue
        expected = sum(others) / len(others)
        assert row["baseline_activity"] == pytest.approx(expected, abs=1e-6)
        if expected == 0:
            assert row["activity_ratio"] is None and row["hotspot_flag"] is False
            continue
        assert row["activity_ratio"] == pytest.approx(value / round(expected, 6), abs=2e-6)
        assert row["hotspot_flag"] == (row["activity_ratio"] >= 2.0)
        spread = round(statistics.stdev(same), 6)
        if spread:
            assert row["hotspot_score"] == pytest.approx((value - expected) / spread, abs=1e-4)
        else:
            assert row["hotspot_score"] is None


def test_alert_levels_and_stable_ids(spots):
    alerts = analytics.activity_alerts(spots, AT).collect()
    again = analytics.activity_alerts(spots, datetime(2025, 1, 1)).collect()
    assert alerts and {a["alert_id"] for a in alerts} == {a["alert_id"] for a in again}
    assert len({a["alert_id"] for a in alerts}) == len(alerts)
    for a in alerts:
        level = "CRITICAL" if a["ratio"] >= 5 else "HIGH" if a["ratio"] >= 3 else "MEDIUM"
        assert a["ratio"] >= 2 and a["alert_level"] == level and a["created_at"] == AT


def test_spine_is_complete(rows, hourly):
    spine = analytics.hourly_spine(hourly)
    assert spine.count() == 6 * 9 * 24
    present = {(c, w) for w, c, _, _ in rows}
    for r in spine.collect():
        assert r["is_missing"] == ((r["grid_id"], r["timestamp"]) not in present)
    total = spine.agg(F.sum("total_activity")).first()[0]
    assert total == pytest.approx(sum(v for _, _, v, _ in rows))


def test_spine_of_a_given_range_and_cells(spark, hourly):
    cells = spark.createDataFrame([("0",), ("99",)], "grid_id string")
    spine = analytics.hourly_spine(hourly, cells, START, START + timedelta(days=9, hours=-1))
    assert spine.where("grid_id = '99' and is_missing").count() == 9 * 24


def test_spine_tasks_hold_a_bounded_number_of_rows(hourly, monkeypatch):
    """Cells and hours decide how many tasks share the spine, not the size that these rows shrink to in a shuffle."""
    monkeypatch.setattr(analytics, "SPINE_ROWS", 100, raising=False)
    spine = analytics.hourly_spine(hourly)
    assert spine.rdd.getNumPartitions() >= 6 * 9 * 24 // 100
    # Cells are spread before they expand, too: few bytes of ids would stay in one task.
    assert spine._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression [grid_id") == 2
    assert spine.count() == 6 * 9 * 24


def test_spine_carries_measures(hourly, rows):
    """What the aggregation carries along needs no join with the spine; hours without rows have none."""
    spine = analytics.hourly_spine(hourly.withColumn("sms_in", F.col("total_activity") * 3), carried=("sms_in",))
    assert "Join" not in spine._jdf.queryExecution().executedPlan().toString()
    found = {(r["timestamp"], r["grid_id"]): r["sms_in"] for r in spine.collect() if not r["is_missing"]}
    assert found == {(when, cell): pytest.approx(3 * value) for when, cell, value, _ in rows}
    assert spine.where("is_missing and sms_in is not null").count() == 0


def test_features_look_back_only(hourly):
    """Changing later hours changes no earlier feature."""
    cut = START + timedelta(days=6)
    inputs = ["lag_1", "lag_2", "lag_24", "trailing_baseline", "trailing_ratio", "total_activity"]
    changed = hourly.withColumn(
        "total_activity",
        F.when(F.col("timestamp") >= F.lit(cut), F.col("total_activity") * 50).otherwise(F.col("total_activity")),
    )
    before = risk.risk_features(analytics.hourly_spine(hourly)).where(F.col("timestamp") < F.lit(cut))
    after = risk.risk_features(analytics.hourly_spine(changed)).where(F.col("timestamp") < F.lit(cut))
    columns = ["grid_id", "timestamp", *inputs]
    assert before.select(columns).exceptAll(after.select(columns)).count() == 0


def test_features_against_brute_force(hourly):
    spine = {(r["grid_id"], r["timestamp"]): r for r in analytics.hourly_spine(hourly).collect()}
    found = {(r["grid_id"], r["timestamp"]): r for r in risk.risk_features(analytics.hourly_spine(hourly)).collect()}

    def ratio(cell, when):
        earlier = [
            spine[(cell, when - timedelta(days=n))]["total_activity"]
            for n in range(1, 9)
            if (cell, when - timedelta(days=n)) in spine and not spine[(cell, when - timedelta(days=n))]["is_missing"]
        ]
        base = round(sum(earlier) / len(earlier), 6) if earlier else None
        return spine[(cell, when)]["total_activity"] / base if base else None

    for (cell, when), row in found.items():
        day_before = spine.get((cell, when - timedelta(days=1)))
        assert row["lag_24"] == (day_before["total_activity"] if day_before else None)
        wanted = ratio(cell, when)
        if wanted is None:
            assert row["trailing_ratio"] is None
        else:
            assert row["trailing_ratio"] == pytest.approx(wanted, abs=1e-5)
        following = when + timedelta(hours=1)
        if (cell, following) not in spine:
            assert row["label"] is None
        else:
            after = ratio(cell, following)
            assert row["label"] == int(after is not None and after >= 2.0 - 1e-9)


def test_risk_scores(hourly, spark):
    features = risk.risk_features(analytics.hourly_spine(hourly)).persist()
    model = risk.train_risk_model(features)
    scores = risk.risk_scores(model, features, AT).persist()
    assert scores.count() == features.count()
    assert gate2.risk_check(scores).first()["passed"]
    assert {r["risk_level"] for r in scores.select("risk_level").distinct().collect()} <= {"LOW", "MEDIUM", "HIGH"}
    # The arithmetic agrees with the model's own prediction.
    from pyspark.ml.linalg import Vectors

    sample = risk._filled(features).orderBy("grid_id", "timestamp").limit(5).collect()
    wanted = {r["timestamp"]: model.predictProbability(Vectors.dense([r[c] for c in risk.FEATURES]))[1] for r in sample}
    found = {r["timestamp"]: r["risk_score"] for r in scores.where("grid_id = '0'").collect()}
    for when, value in wanted.items():
        assert found[when] == pytest.approx(value, abs=1e-9)
    again = risk.risk_scores(risk.train_risk_model(features), features, AT)
    left = {(r[0], r[1]): r[2] for r in scores.select("grid_id", "timestamp", "risk_score").collect()}
    for r in again.collect():
        assert r["risk_score"] == pytest.approx(left[(r["grid_id"], r["timestamp"])], abs=1e-6)
    features.unpersist()
    scores.unpersist()


def test_one_class_only(spark):
    flat = spark.createDataFrame(
        [(START + timedelta(hours=h), "1", 1.0, 0.5) for h in range(72)],
        "timestamp timestamp, grid_id string, total_activity double, internet_activity double",
    )
    features = risk.risk_features(analytics.hourly_spine(flat))
    scores = risk.risk_scores(risk.train_risk_model(features), features, AT)
    assert gate2.risk_check(scores).first()["passed"]


def test_pages_cover_all_alerts_once(spots):
    alerts = analytics.activity_alerts(spots, AT)
    ids = []
    for page in range(1, 1 + -(-alerts.count() // 7)):
        ids += [r["alert_id"] for r in reports.alerts_page(alerts, page, 7).collect()]
    ordered = alerts.orderBy(F.desc("timestamp"), "alert_id").collect()
    assert ids == [r["alert_id"] for r in ordered]
    assert reports.alerts_page(alerts, alert_type="DROP").count() == 0
    followed = reports.alerts_page(alerts, 1, 7).collect()
    while len(followed) < len(ordered):
        last = followed[-1]
        followed += reports.alerts_after(alerts, last["timestamp"], last["alert_id"], 7).collect()
    assert followed == ordered


def test_date_comparison(rows, hourly):
    values = {(c, w): v for w, c, v, _ in rows}
    for r in reports.date_comparison(hourly).collect():
        assert r["day_before"] == values.get((r["grid_id"], r["timestamp"] - timedelta(days=1)))
        assert r["week_before"] == values.get((r["grid_id"], r["timestamp"] - timedelta(days=7)))


def test_compare_one_cell_only(hourly):
    one = hourly.where("grid_id = '1'")
    assert reports.compare_busiest(one).where("activity_b is not null").count() == 0


def test_risk_evidence(spark):
    scores = spark.createDataFrame(
        [("1", START, 0.9, "HIGH"), ("1", START + timedelta(hours=1), 0.2, "LOW")],
        "grid_id string, timestamp timestamp, risk_score double, risk_level string",
    )
    features = spark.createDataFrame(
        [("1", START, 3.0), ("1", START + timedelta(hours=1), 4.0)],
        "grid_id string, timestamp timestamp, trailing_ratio double",
    )
    rows = reports.risk_evidence(scores, features, 0.5).collect()
    assert [(r["risk_level"], r["trailing_ratio"]) for r in rows] == [("HIGH", 3.0)]
