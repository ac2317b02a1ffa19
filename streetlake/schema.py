"""Canonical frame layouts (wire event, raw, clean, analytics, alert, daily)."""

from __future__ import annotations

from pyspark.sql import types as T

# The event as it travels on the wire (JSON text); `timestamp` is ISO-8601.
WIRE_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("camera_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("vehicle_count", T.IntegerType()),
    T.StructField("average_speed", T.DoubleType()),
    T.StructField("congestion_level", T.StringType()),
    T.StructField("congestion_score", T.DoubleType()),
    T.StructField("accident_detected", T.BooleanType()),
    T.StructField("pedestrian_count", T.IntegerType()),
    T.StructField("heavy_vehicle_pct", T.DoubleType()),
    T.StructField("producer_version", T.StringType()),
    T.StructField("schema_version", T.StringType()),
])

WIRE_FIELDS = [f.name for f in WIRE_SCHEMA.fields]

EVENT_FIELDS = ["event_id", "camera_id", "event_ts", "location", "latitude", "longitude",
                "vehicle_count", "average_speed", "congestion_level", "congestion_score",
                "accident_detected", "pedestrian_count", "heavy_vehicle_pct",
                "producer_version", "schema_version"]
KAFKA_FIELDS = ["kafka_offset", "kafka_partition", "kafka_ingest_ts"]
RAW_FIELDS = EVENT_FIELDS + KAFKA_FIELDS          # + original `value` text when kept
DERIVED_FIELDS = ["speed_index", "congestion_category", "is_peak_hour",
                  "pipeline_ts", "event_date", "event_hour"]
CLEAN_FIELDS = RAW_FIELDS + DERIVED_FIELDS

FEATURE_COLS = ["vehicle_count", "average_speed", "congestion_score",
                "pedestrian_count", "heavy_vehicle_pct", "event_hour"]
# features stored with integers; the rest carry <= 2 decimals by contract
INTEGRAL_FEATURES = {"vehicle_count", "pedestrian_count", "event_hour"}

ANALYTICS_FIELDS = ["camera_id", "location", "window_start", "window_end",
                    "avg_vehicle_count", "max_vehicle_count", "min_vehicle_count",
                    "avg_speed", "min_speed", "avg_congestion_score", "max_congestion_score",
                    "accident_count", "event_count", "congestion_category"]

ALERT_FIELDS = ["alert_id", "camera_id", "alert_type", "severity", "anomaly_score",
                "message", "created_at", "baseline_vehicle_count",
                "current_vehicle_count", "pct_above_baseline"]

DAILY_FIELDS = ["summary_date", "camera_id", "location", "total_events",
                "avg_vehicle_count", "max_vehicle_count", "avg_speed", "min_speed",
                "total_accidents", "avg_congestion_score", "peak_hour"]
