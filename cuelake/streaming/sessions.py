"""Cues that arrive as a stream: frame sessions by event time, and running counters of a track."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def session_windows(points: DataFrame, key: str, time: str, gap: str, late: str) -> DataFrame:
    """Sessions of points no more than ``gap`` apart, for each key; points later than ``late`` behind the newest are left out."""
    grouped = points.withWatermark(time, late).groupBy(key, F.session_window(time, gap).alias("w"))
    return grouped.agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("first"), F.col("w.end").alias("until"), "n")


def running_counts(cues: DataFrame) -> DataFrame:
    """Per track: cues so far, and the latest end; complete or update mode."""
    return cues.groupBy("track_id").agg(F.count("*").alias("cues"), F.max("end_ms").alias("until_ms"))


def start(result: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Writes a stream to Parquet for what is there now; a restart goes on from the checkpoint."""
    return result.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
