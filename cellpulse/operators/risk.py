"""Risk that the next hour of a cell becomes a hotspot.

Features look only back in time. The leave-one-out baseline of the hotspot table
sees later days and is not used here.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellpulse.functions.measures import safe_ratio, settled
from cellpulse.operators.analytics import HOTSPOT_RATIO

LAGS = (1, 2, 24)
FEATURES = (
    "total_activity",
    *[f"lag_{n}" for n in LAGS],
    "trailing_ratio",
    "hour",
    "day_of_week",
    "internet_share",
)
# Lowest score of each risk level, highest level first.
RISK_LEVELS = (("HIGH", 0.7), ("MEDIUM", 0.4))
MODEL_VERSION = "logistic-1"
TRAIN_SHARE = 0.8


@dataclass(frozen=True)
class Weights:
    """A model as numbers: one coefficient for each of ``FEATURES``."""

    intercept: float
    coefficients: tuple[float, ...]
    version: str


# A published model, for scores that do not change with the training data.
PUBLISHED = Weights(-2.0, (0.002, -0.001, -0.0005, 0.001, 0.4, 0.01, -0.02, 0.3), "logistic-fixed-1")


def weights_of(model: LogisticRegressionModel, version: str = MODEL_VERSION) -> Weights:
    return Weights(float(model.intercept), tuple(float(w) for w in model.coefficients.toArray()), version)


def risk_features(spine: DataFrame, min_ratio: float = HOTSPOT_RATIO) -> DataFrame:
    """Lags, ratio to the trailing mean of the same hour, calendar, and the label.

    Runs on the complete spine, so that a lag of 24 rows is a lag of 24 hours and
    a cell has exactly one row an hour: window groups are as long as the date
    range, whatever the skew of the source rows. The spine comes placed by cell,
    so no window needs a shuffle; there is one sort for the trailing mean and one
    for lags and label. ``label`` is null in the last hour, which has no next one.
    """
    per_cell = Window.partitionBy("grid_id").orderBy("timestamp")
    earlier_days = (
        Window.partitionBy("grid_id", "hour")
        .orderBy("timestamp")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = F.when(~F.col("is_missing"), F.col("total_activity"))
    trended = spine.withColumns(
        {"hour": F.hour("timestamp"), "day_of_week": F.dayofweek("timestamp")}
    ).withColumn("trailing_baseline", settled(F.avg(seen).over(earlier_days)))
    rated = trended.withColumn(
        "trailing_ratio", safe_ratio(F.col("total_activity"), F.col("trailing_baseline"))
    )
    is_hot = F.coalesce(F.col("trailing_ratio") >= min_ratio, F.lit(False)).cast("int")
    return rated.withColumn("is_hot", is_hot).select(
        "grid_id",
        "timestamp",
        "total_activity",
        *[F.lag("total_activity", n).over(per_cell).alias(f"lag_{n}") for n in LAGS],
        "trailing_baseline",
        "trailing_ratio",
        "hour",
        "day_of_week",
        "internet_share",
        F.lead("is_hot").over(per_cell).alias("label"),
    )


def split_time(features: DataFrame, share: float = TRAIN_SHARE) -> Column:
    """The time that ends the first ``share`` of the range, as a scalar subquery."""
    low, high = F.min("timestamp").cast("bigint"), F.max("timestamp").cast("bigint")
    return features.agg(
        F.timestamp_seconds(F.floor(low + (high - low) * share)).alias("split")
    ).scalar()


def _filled(features: DataFrame) -> DataFrame:
    return features.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("double") for c in FEATURES})


def train_risk_model(features: DataFrame, until: Column | None = None) -> LogisticRegressionModel:
    """Logistic regression on the rows before ``until``; later rows stay unseen."""
    end = split_time(features) if until is None else until
    rows = _filled(features.where(F.col("label").isNotNull() & (F.col("timestamp") < end)))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    vectors = assembler.transform(rows).select("features", F.col("label").cast("double").alias("label"))
    return LogisticRegression(family="binomial", maxIter=25, regParam=0.01).fit(vectors)


def _probability(weights: Weights) -> Column:
    pairs = zip(FEATURES, weights.coefficients, strict=True)
    margin = sum((F.col(c) * w for c, w in pairs), start=F.lit(weights.intercept))
    return 1.0 / (1.0 + F.exp(-margin))


def risk_evaluation(
    model: LogisticRegressionModel | Weights, features: DataFrame, since: Column | None = None, bins: int = 1000
) -> DataFrame:
    """How the model does on the rows from ``since`` on, which training has not seen: one row.

    ``auc`` is the chance that a hot hour scores higher than another one, from
    counts by score in ``bins`` steps; ``log_loss`` and ``base_loss`` (of the
    share of hot hours alone) say whether probabilities are worth anything.
    """
    weights = model if isinstance(model, Weights) else weights_of(model)
    start = split_time(features) if since is None else since
    held = _filled(features.where(F.col("label").isNotNull() & (F.col("timestamp") >= start)))
    p = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), _probability(weights)))
    loss = -F.when(F.col("label") == 1, F.log("p")).otherwise(F.log(1 - F.col("p")))
    steps = (
        held.withColumn("p", p)
        .groupBy(F.floor(F.col("p") * bins).alias("step"))
        .agg(F.count_if(F.col("label") == 1).alias("hot"), F.count_if(F.col("label") != 1).alias("cold"), F.sum(loss).alias("loss"))
    )
    # At most as many rows as there are steps.
    below = F.coalesce(F.sum("cold").over(Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    won = F.col("hot") * (below + F.col("cold") / 2)
    total = steps.withColumn("won", won).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("hot", "cold", "won", "loss")]
    )
    n, share = F.col("hot") + F.col("cold"), F.try_divide(F.col("hot"), F.col("hot") + F.col("cold"))
    entropy = lambda x: F.when(x > 0, -x * F.log(x)).otherwise(F.lit(0.0))
    return total.select(
        n.alias("held_out_rows"),
        F.col("hot").alias("hot_rows"),
        F.try_divide("won", F.col("hot") * F.col("cold")).alias("auc"),
        F.try_divide("loss", n).alias("log_loss"),
        (entropy(share) + entropy(1 - share)).alias("base_loss"),
    )


def risk_scores(
    model: LogisticRegressionModel | Weights,
    features: DataFrame,
    scored_at: datetime,
    version: str | None = None,
    levels=RISK_LEVELS,
) -> DataFrame:
    """Probability of a hotspot in the next hour, for every row given.

    The model is a handful of weights, so the score is column arithmetic: rows
    need no vectors and no function call outside generated code.
    """
    weights = model if isinstance(model, Weights) else weights_of(model)
    scored = _filled(features).withColumn("risk_score", _probability(weights))
    level = F.coalesce(
        *[F.when(F.col("risk_score") >= lowest, F.lit(name)) for name, lowest in levels], F.lit("LOW")
    )
    return scored.select(
        "grid_id",
        "timestamp",
        "risk_score",
        level.alias("risk_level"),
        F.lit(version or weights.version).alias("model_version"),
        F.lit(scored_at).cast("timestamp").alias("scored_at"),
    )
