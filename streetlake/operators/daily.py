"""Daily close: per-camera daily summary (A2), the report (A5/V9) and the
idempotent replace-one-day write (K6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X


def daily_summary(clean: DataFrame, date=None) -> DataFrame:
    """A2: per (day, camera, location) counts, means, extremes and peak hour.

    ``peak_hour`` is the hour with most events (ties: the earliest hour), the
    deterministic ``mode`` aggregate, which merges map-side.
    """
    df = clean
    if date is not None:
        df = df.filter(F.col("event_date") == F.lit(str(date)).cast("date"))
    return (df.groupBy(F.col("event_date").alias("summary_date"), "camera_id", "location")
            .agg(F.count(F.lit(1)).alias("total_events"),
                 X.mean_of("vehicle_count", integral=True).alias("avg_vehicle_count"),
                 F.max("vehicle_count").alias("max_vehicle_count"),
                 X.mean_of("average_speed").alias("avg_speed"),
                 F.min("average_speed").alias("min_speed"),
                 F.sum(F.col("accident_detected").cast("int")).alias("total_accidents"),
                 X.mean_of("congestion_score").alias("avg_congestion_score"),
                 F.mode("event_hour", True).alias("peak_hour")))


def daily_report(summary: DataFrame, date=None) -> DataFrame:
    """A5/V9: report row per day: cameras, events, unweighted mean of the
    per-camera means (1 dp, null when 0 or missing), accidents."""
    df = summary
    if date is not None:
        df = df.filter(F.col("summary_date") == F.lit(str(date)).cast("date"))
    out = df.groupBy(F.col("summary_date").alias("date")).agg(
        F.count_distinct("camera_id").alias("cameras"),
        F.sum("total_events").alias("total_events"),
        F.avg("avg_vehicle_count").alias("_veh"),
        F.avg("avg_speed").alias("_spd"),
        F.sum("total_accidents").alias("accidents"),
        F.avg("avg_congestion_score").alias("_cong"))
    return out.select("date", "cameras", "total_events",
                      X.nonzero_round(F.col("_veh"), 1).alias("avg_vehicles"),
                      X.nonzero_round(F.col("_spd"), 1).alias("avg_speed_kmh"),
                      "accidents",
                      X.nonzero_round(F.col("_cong"), 1).alias("avg_congestion"))


def replace_day(df: DataFrame, path: str, fmt: str = "parquet", date=None) -> None:
    """K6: replace the summary partitions present in ``df`` (others kept).

    Dynamic partition overwrite makes a re-run of the same day idempotent.
    With ``date``, that day alone is replaced, also by no rows.
    """
    if date is not None:
        df = df.filter(F.col("summary_date") == F.lit(str(date)).cast("date"))
        if df.isEmpty():
            from ..plans.maintenance import drop_partition
            drop_partition(df.sparkSession, path, "summary_date", date)
            return
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("summary_date")
     .format(fmt).save(path))
