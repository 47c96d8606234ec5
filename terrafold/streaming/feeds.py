"""Streams: incremental permits and event-time counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_counts(events: DataFrame, width: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums by event time; works on tables and streams."""
    span = F.window("ts", width, slide) if slide else F.window("ts", width)
    own = events.withWatermark("ts", late) if events.isStreaming else events
    return own.groupBy(span.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    own = events.withWatermark("ts", late) if events.isStreaming else events
    return own.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def permit_feed(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str, late: str = "7 days") -> StreamingQuery:
    """Permits as they arrive: repeats within the watermark drop out, each batch
    goes to ``merge`` (see ``rollups.PermitRollups.follow``, which re-rolls the parcels that
    a batch touches, and ``runs.merge_window``)."""
    own = stream.withWatermark("modified", late).dropDuplicatesWithinWatermark(["number", "status"])
    return own.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
