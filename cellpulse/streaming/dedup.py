"""Streams that store a row once, with state that is bounded by time instead of growing with history."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cellpulse.streaming.incremental import GRAIN

DELAY = "3 days"


def unique_rows(clean: DataFrame, delay: str = DELAY) -> DataFrame:
    """The first row of each (time, cell, country), as a stateful stream.

    The state store keeps a key until the watermark, the latest time seen less
    ``delay``, has passed it; then it is evicted. What comes again before that is recognised by
    its key; what is older than the watermark is left out as too late, whether it has come before
    or not, so ``delay`` must cover how late a first delivery may be.
    """
    return clean.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(list(GRAIN))


def append_unique(clean: DataFrame, path: str, checkpoint: str, delay: str = DELAY) -> list[dict]:
    """Append the new unique rows of all files that have come, then stop.

    Returns one entry per micro-batch: rows in, rows too late, and keys held in the state
    store afterwards. A restart goes on from the checkpoint; the file sink's log
    makes a repeated batch write nothing twice.
    """
    query = (
        unique_rows(clean, delay)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    found = []
    for progress in query.recentProgress:
        states = progress["stateOperators"]
        found.append(
            {
                "rows_in": progress["numInputRows"],
                "too_late": sum(s["numRowsDroppedByWatermark"] for s in states),
                "state_rows": sum(s["numRowsTotal"] for s in states),
            }
        )
    return found
