"""Window aggregates per camera.

One function serves batch and streaming: on a streaming frame the event-time
watermark is applied first and the aggregate runs in append mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X

WATERMARK = "10 minutes"
WINDOW = "5 minutes"
SLIDE = "1 minute"


def traffic_aggs() -> list[Column]:
    """A1: the analytics-zone aggregates (exact means; the window's category is
    that of its earliest event, deterministic under any partitioning)."""
    return [
        X.mean_of("vehicle_count", integral=True).alias("avg_vehicle_count"),
        F.max("vehicle_count").alias("max_vehicle_count"),
        F.min("vehicle_count").alias("min_vehicle_count"),
        X.mean_of("average_speed").alias("avg_speed"),
        F.min("average_speed").alias("min_speed"),
        X.mean_of("congestion_score").alias("avg_congestion_score"),
        F.max("congestion_score").alias("max_congestion_score"),
        F.sum(F.col("accident_detected").cast("int")).alias("accident_count"),
        F.count(F.lit(1)).alias("event_count"),
        # the score decides among events of one time without ids; rows that tie there too have one category
        F.min_by("congestion_category", F.struct("event_ts", "event_id", "congestion_score")).alias("congestion_category"),
    ]


def sliding_metrics(clean: DataFrame, window: str = WINDOW, slide: str | None = SLIDE,
                    watermark: str = WATERMARK, processing_time: bool = False) -> DataFrame:
    """Per (window, camera, location) metrics; tumbling when slide is None
    or equal to the window (T3).  Streaming input gets the watermark (T1)."""
    df = clean
    if df.isStreaming and "spark.watermarkDelayMs" not in df.schema["event_ts"].metadata:
        df = df.withWatermark("event_ts", watermark)
    w = F.window("event_ts", window, slide) if slide and slide != window else F.window("event_ts", window)
    out = (df.groupBy(w.alias("window"), F.col("camera_id"), F.col("location"))
           .agg(*traffic_aggs())
           .select("camera_id", "location",
                   F.col("window.start").alias("window_start"),
                   F.col("window.end").alias("window_end"),
                   "avg_vehicle_count", "max_vehicle_count", "min_vehicle_count",
                   "avg_speed", "min_speed", "avg_congestion_score", "max_congestion_score",
                   "accident_count", "event_count", "congestion_category"))
    if processing_time:
        out = out.withColumn("agg_ts", F.current_timestamp())
    return out


def tumbling_metrics(clean: DataFrame, window: str = "1 hour", **kw) -> DataFrame:
    """The tumbling special case of ``sliding_metrics``."""
    return sliding_metrics(clean, window=window, slide=None, **kw)
