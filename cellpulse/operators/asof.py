"""As-of joins: each event with the last state of its key at or before its time, without a range join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_state(
    events: DataFrame, states: DataFrame, key: str = "grid_id", time: str = "timestamp", carried: tuple[str, ...] = ()
) -> DataFrame:
    """``events`` with ``state_time`` and the ``carried`` columns of the last state; null where there is none.

    Events and states are united, and a running last value per key and day runs
    over them; a state counts for events of its own time. What a day begins with comes from one
    row per key and day, so a key with a third of all rows is divided by its days. Of states of
    one time the one with the greatest values counts. An event without key or time has none.
    """
    empty = states.select(*[F.lit(None).cast(states.schema[c].dataType).alias(c) for c in carried]).columns
    value = lambda: F.struct(F.col(time).alias("state_time"), *[F.col(c) for c in carried])
    kind = states.select(value().alias("s")).schema["s"].dataType
    own = events.select(F.struct("*").alias("event"), F.col(key).alias("key"), F.col(time).alias("time"), F.lit(None).cast(kind).alias("s"))
    known = states.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    other = known.select(F.lit(None).cast(own.schema["event"].dataType).alias("event"), F.col(key).alias("key"), F.col(time).alias("time"), value().alias("s"))
    day = F.to_date("time")
    united = own.unionByName(other).withColumn("day", day)
    # States of one time come in the order of their values, events of that time after them.
    order = [F.col("time"), F.col("event").isNotNull(), F.col("s")]
    within = Window.partitionBy("key", "day").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = united.withColumn("last", F.last("s", ignorenulls=True).over(within)).where("event is not null")
    ends = other.groupBy("key", F.to_date("time").alias("day")).agg(F.max("s").alias("end"))
    # A day that has events but no states takes over what the day before began with.
    days = ends.unionByName(own.select("key", day.alias("day"), F.lit(None).cast(kind).alias("end")).distinct())
    days = days.groupBy("key", "day").agg(F.max("end").alias("end"))
    before = Window.partitionBy("key").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    begins = days.select("key", "day", F.last("end", ignorenulls=True).over(before).alias("begin"))
    found = rows.join(begins, ["key", "day"], "left").withColumn("found", F.coalesce("last", "begin"))
    found = found.withColumn("found", F.when(F.col("key").isNotNull() & F.col("time").isNotNull(), F.col("found")))
    return found.select("event.*", "found.state_time", *[f"found.{c}" for c in empty])
