"""Run metrics over time; the same functions serve batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _source(events: DataFrame, late: str | None) -> DataFrame:
    """Watermarks ask for times with a zone."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if late else events


def tumbling(events: DataFrame, size: str, late: str | None = None) -> DataFrame:
    """(window_start, event_type, runs, total). late: how long a stream waits for events out of order."""
    source = _source(events, late)
    out = source.groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("runs"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("window_start"), "event_type", "runs", "total")


def sliding(events: DataFrame, size: str, step: str, late: str | None = None) -> DataFrame:
    source = _source(events, late)
    out = source.groupBy(F.window("ts", size, step), "event_type").agg(F.count("*").alias("runs"))
    return out.select(F.col("window.start").alias("window_start"), "event_type", "runs")


def sessions(events: DataFrame, gap: str, late: str | None = None) -> DataFrame:
    """(user_id, session_start, runs): events of a user less than a gap apart belong together."""
    source = _source(events, late)
    out = source.groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("runs"))
    return out.select("user_id", F.col("session_window.start").alias("session_start"), "runs")
