"""Risk scores as a job over the published hourly table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpulse.functions.digest import content_by_date
from cellpulse.operators import analytics, gate2, risk
from cellpulse.plans.batch import HOURLY
from cellpulse.plans.publish import new_attempt, publish, read_published, require_passed, run_path, write_by_date

SCORES = "risk_scores"


def run_risk(
    spark: SparkSession, output: str, run_id: str, run_at: datetime, version: str = risk.MODEL_VERSION
) -> DataFrame:
    """Train on the earlier part of the published hours, score all of them, check, publish.

    Training passes over the features several times, so they are stored first.
    """
    attempt = new_attempt()
    spine = analytics.hourly_spine(read_published(spark, output, HOURLY))
    dated = risk.risk_features(spine).withColumn("date", F.to_date("timestamp"))
    features = write_by_date(dated, run_path(output, "risk_features", run_id, attempt))
    model = risk.train_risk_model(features)
    scores = risk.risk_scores(model, features, run_at, version).withColumn("date", F.to_date("timestamp"))
    stored = write_by_date(scores, run_path(output, SCORES, run_id, attempt))
    require_passed(gate2.risk_check(stored))
    publish(spark, output, run_id, attempt, {SCORES: stored}, {SCORES: content_by_date(stored)}, run_at)
    return stored
