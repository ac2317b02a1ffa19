"""Enrichment (P1-P6) and the zone lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.registry import camera_registry, is_fixed_size
from .joins import attach_small


def enrich(df: DataFrame, processing_time: bool = True) -> DataFrame:
    """Add speed_index, congestion_category, is_peak_hour, pipeline_ts,
    event_date and event_hour.  ``pipeline_ts`` is processing time and is
    left out when ``processing_time`` is False (deterministic frames)."""
    out = (df
           .withColumn("speed_index", X.speed_index("average_speed"))
           .withColumn("congestion_category", X.congestion_category("congestion_score"))
           .withColumn("is_peak_hour", X.is_peak_hour("event_ts")))
    if processing_time:
        out = out.withColumn("pipeline_ts", F.current_timestamp())
    return (out
            .withColumn("event_date", F.to_date("event_ts"))
            .withColumn("event_hour", F.hour("event_ts").cast("int")))


def with_zone(df: DataFrame, registry: DataFrame | None = None, how: str = "left") -> DataFrame:
    """Attach ``zone`` and ``active`` from the camera registry.

    The fixed seed (or any driver-local registry) is broadcast as is; a registry
    read from a table goes through the size-checked ``attach_small``.  Events
    of cameras outside it keep a null zone (``how='left'``).
    """
    reg = registry if registry is not None else camera_registry(df.sparkSession)
    dim = reg.select("camera_id", "zone", "active")
    if is_fixed_size(reg) or reg.isLocal() or df.isStreaming:
        return df.join(F.broadcast(dim), "camera_id", how)
    return attach_small(df, dim, "camera_id", how)
