"""Serving queries over the clean zone and the alerts table.

Each endpoint of an operational API is a function returning a DataFrame.
``as_of`` replaces ``NOW()``: a timestamp, a Column (e.g. a scalar subquery)
or None for the current time.  Everything is an aggregate or a join of small
per-key aggregates; nothing is funnelled through one task or the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.registry import camera_registry
from ..session import cut_lineage
from .enrich import with_zone
from .joins import attach_small, join_counted

LIVE_COLS = ["camera_id", "location", "vehicle_count", "average_speed", "congestion_score",
             "congestion_level", "accident_detected", "event_ts"]
MAX_ALERT_LIMIT = 500


def _minutes(m: float) -> Column:
    return F.expr(f"INTERVAL {int(m * 60)} SECONDS")


def _window(df: DataFrame, as_of, minutes: float | None) -> DataFrame:
    """Rows with event_ts in [as_of - minutes, as_of].

    On a zone partitioned by ``event_date`` / ``event_hour`` the implied
    (day, hour) range is added so only the touched directories are read.
    """
    if minutes is None:
        return df
    now = X.ts_value(as_of)
    lo = now - _minutes(minutes)
    out = df.filter((F.col("event_ts") >= lo) & (F.col("event_ts") <= now))
    parts = X.partition_range(df.columns, lo, now)
    return out if parts is None else out.filter(parts)


def latest_per_camera(clean: DataFrame, as_of=None, minutes: float | None = 5,
                      cols=LIVE_COLS) -> DataFrame:
    """Newest row per camera within the look-back (ties: larger event_id).

    ``max_by`` is a two-phase aggregate (no window function): a hot camera is
    combined map-side instead of landing whole in one task.
    """
    recent = _window(clean, as_of, minutes)
    rest = [c for c in cols if c != "camera_id"]
    return (recent.groupBy("camera_id")
            .agg(F.max_by(F.struct(*rest), F.struct("event_ts", "event_id")).alias("r"))
            .select("camera_id", *[F.col("r." + c).alias(c) for c in rest]))


def live_metrics(clean: DataFrame, as_of=None, minutes: float = 5, camera_id: str | None = None) -> DataFrame:
    """V1: latest observation per camera with its lower-case status."""
    df = clean if camera_id is None else clean.filter(F.col("camera_id") == camera_id)
    return latest_per_camera(df, as_of, minutes).withColumn(
        "status", X.congestion_status("congestion_score"))


def platform_summary(clean: DataFrame, alerts: DataFrame, registry: DataFrame | None = None,
                     as_of=None) -> DataFrame:
    """V2: one-row KPI summary for the as_of day.

    The day is read once; alert and registry counts enter as scalar subqueries
    (no cross join).  ``pipeline_sla_pct`` is data-derived: the percentage of
    (registry camera, minute) cells of the day so far that have an event.
    """
    now = X.ts_value(as_of)
    reg = registry if registry is not None else camera_registry(clean.sparkSession)
    active = (alerts.filter((F.col("created_at") >= now - _minutes(60)) & (F.col("created_at") <= now)
                            & unacknowledged_at(now))
              .agg(F.count(F.lit(1))).scalar())
    total_cams = reg.agg(F.count(F.lit(1))).scalar()
    known = reg.select("camera_id").distinct().withColumn("_known", F.lit(True))
    today = day_so_far(clean, now)
    # the built-in registry is fixed in size; a caller's is counted before it is broadcast
    today = today.join(F.broadcast(known), "camera_id", "left") if registry is None \
        else attach_small(today, known, "camera_id", "left")
    minutes_so_far = F.hour(now) * 60 + F.minute(now) + 1
    return today.agg(
        F.count(F.lit(1)).alias("total_events_today"),
        F.count_distinct("camera_id").alias("active_cameras"),
        X.mean_of("average_speed").alias("_spd"),
        X.mean_of("congestion_score").alias("_score"),
        F.count_if(F.col("event_ts") >= now - F.expr("INTERVAL 1 SECOND")).alias("_eps"),
        # SLA: (registry camera, minute) cells of the day so far with data
        F.count_distinct(F.when(F.col("_known"), F.col("camera_id")),
                         F.date_trunc("minute", "event_ts")).alias("_cells"),
    ).select(
        "total_events_today", "active_cameras",
        total_cams.alias("total_cameras"),
        F.round(F.coalesce(F.col("_spd"), F.lit(0.0)), 1).alias("avg_speed_kmh"),
        F.round(F.coalesce(F.col("_score"), F.lit(0.0)), 1).alias("avg_congestion_score"),
        active.alias("active_anomalies"),
        F.round(F.lit(100.0) * F.col("_cells") / (total_cams * minutes_so_far), 1).alias("pipeline_sla_pct"),
        F.round(F.col("_eps").cast("double"), 1).alias("events_per_second"),
        now.alias("last_updated"),
    )


def day_so_far(clean: DataFrame, now: Column) -> DataFrame:
    """Events of the day of ``now`` up to ``now``: later ones have not happened yet."""
    return clean.filter((F.col("event_date") == F.to_date(now)) & (F.col("event_ts") <= now))


def unacknowledged_at(now: Column) -> Column:
    """Alert not acknowledged as of ``now`` (acknowledged_at null or later)."""
    return F.col("acknowledged_at").isNull() | (F.col("acknowledged_at") > now)


def recent_alerts(alerts: DataFrame, severity: str | None = None, limit: int = 50) -> DataFrame:
    """Newest alerts first, optional severity filter, limit <= 500."""
    if limit > MAX_ALERT_LIMIT or limit < 1:
        raise ValueError(f"limit must be in 1..{MAX_ALERT_LIMIT}")
    df = alerts if severity is None else alerts.filter(F.col("severity") == severity.upper())
    return df.orderBy(F.col("created_at").desc(), F.col("alert_id")).limit(limit)


def hourly_profile(clean: DataFrame, date=None, camera_id: str | None = None) -> DataFrame:
    """Hourly averages; all dates when ``date`` is None."""
    df = clean
    if date is not None:
        df = df.filter(F.col("event_date") == F.lit(str(date)).cast("date"))
    if camera_id is not None:
        df = df.filter(F.col("camera_id") == camera_id)
    keys = ["event_date", "event_hour"] if date is None else ["event_hour"]
    return (df.groupBy(*keys).agg(
        X.mean_of("vehicle_count", integral=True).alias("avg_vehicle_count"),
        F.max("vehicle_count").alias("max_vehicle_count"),
        X.mean_of("average_speed").alias("avg_speed"),
        X.mean_of("congestion_score").alias("avg_congestion"),
        F.count(F.lit(1)).alias("event_count"))
        .orderBy(*keys))


def cameras_status(clean: DataFrame, registry: DataFrame | None = None, as_of=None,
                   minutes: float = 5) -> DataFrame:
    """Every registry camera with its latest reading, or ``offline``."""
    reg = registry if registry is not None else camera_registry(clean.sparkSession)
    latest = latest_per_camera(clean, as_of, minutes,
                               ["camera_id", "vehicle_count", "average_speed", "congestion_score", "event_ts"])
    out = reg.join(latest, "camera_id", "left")
    return (out.withColumn("status", F.when(F.col("event_ts").isNull(), "offline")
                           .otherwise(X.congestion_status("congestion_score")))
            .orderBy(F.col("vehicle_count").desc_nulls_last(), "camera_id"))


def camera_detail(clean: DataFrame, registry: DataFrame | None = None, as_of=None,
                  camera_id: str | None = None, minutes: float = 5) -> DataFrame:
    """V6: registry row + latest reading + the as_of day's aggregates."""
    reg = registry if registry is not None else camera_registry(clean.sparkSession)
    if camera_id is not None:
        reg = reg.filter(F.col("camera_id") == camera_id)
        clean = clean.filter(F.col("camera_id") == camera_id)
    status = cameras_status(clean, reg, as_of, minutes)
    now = X.ts_value(as_of)
    today = (day_so_far(clean, now)
             .groupBy("camera_id").agg(
                 F.count(F.lit(1)).alias("events_today"),
                 X.mean_of("vehicle_count", integral=True).alias("avg_vehicle_count_today"),
                 F.max("vehicle_count").alias("max_vehicle_count_today"),
                 X.mean_of("average_speed").alias("avg_speed_today"),
                 X.mean_of("congestion_score").alias("avg_congestion_today")))
    return (status.join(today, "camera_id", "left")
            .withColumn("events_today", F.coalesce(F.col("events_today"), F.lit(0).cast("long"))))


def zone_congestion(clean: DataFrame, registry: DataFrame | None = None, as_of=None,
                    minutes: float | None = None) -> DataFrame:
    """Mean congestion per zone and its level."""
    df = with_zone(_window(clean, as_of, minutes), registry, how="inner")
    out = df.groupBy("zone").agg(
        X.mean_of("congestion_score").alias("avg_congestion_score"),
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("camera_id").alias("cameras"))
    return out.withColumn("congestion_level", X.congestion_category("avg_congestion_score"))


def zone_level_counts(zones: DataFrame) -> DataFrame:
    """V7: number of zones at each congestion level."""
    return zones.groupBy("congestion_level").agg(F.count(F.lit(1)).alias("zones"))


def peak_hours(clean: DataFrame, as_of=None, minutes: float | None = None) -> DataFrame:
    """V8: vehicles by hour of day and the peak hour band (ties: earliest)."""
    by_hour = (_window(clean, as_of, minutes).groupBy("event_hour")
               .agg(F.sum("vehicle_count").alias("total_vehicles"),
                    F.count(F.lit(1)).alias("event_count")))
    # the peak is found over the aggregated rows (at most 24), so this
    # unpartitioned window is bounded and the events are scanned once
    best = F.max(F.struct(F.col("total_vehicles"), -F.col("event_hour"))).over(Window.partitionBy())
    band = F.format_string("%02d:00-%02d:00", F.col("event_hour"), (F.col("event_hour") + 1) % 24)
    return by_hour.select("event_hour", "total_vehicles", "event_count",
                          (-best.getField("col2") == F.col("event_hour")).alias("is_peak"),
                          band.alias("hour_band"))


def hour_over_hour(clean: DataFrame) -> DataFrame:
    """Hourly totals with the change vs the previous clock hour.

    No ``lag`` over an unpartitioned window and no self-join: the hourly
    aggregate is computed once and re-grouped with a shifted copy of itself.
    """
    hourly = (clean.groupBy(F.date_trunc("hour", "event_ts").alias("hour_start"))
              .agg(F.count(F.lit(1)).alias("event_count"),
                   F.sum("vehicle_count").alias("total_vehicles")))
    # each hourly row plays two roles: itself, and "previous" of the next hour;
    # regrouping the small hourly table pairs them without a second scan
    none = F.lit(None).cast("long")
    roles = F.array(
        F.struct(F.col("hour_start").alias("h"), F.col("event_count").alias("c"),
                 F.col("total_vehicles").alias("v"), none.alias("pc"), none.alias("pv")),
        F.struct((F.col("hour_start") + F.expr("INTERVAL 1 HOUR")).alias("h"), none.alias("c"), none.alias("v"),
                 F.col("event_count").alias("pc"), F.col("total_vehicles").alias("pv")))
    paired = (hourly.select(F.explode(roles).alias("r"))
              .groupBy(F.col("r.h").alias("hour_start"))
              .agg(F.max("r.c").alias("event_count"), F.max("r.v").alias("total_vehicles"),
                   F.max("r.pc").alias("prev_event_count"), F.max("r.pv").alias("prev_total_vehicles"))
              .filter(F.col("event_count").isNotNull()))
    return paired.select(
        "hour_start", "event_count", "total_vehicles", "prev_event_count", "prev_total_vehicles",
        X.pct_change(F.col("event_count"), F.col("prev_event_count")).alias("events_pct_change"),
        X.pct_change(F.col("total_vehicles"), F.col("prev_total_vehicles")).alias("vehicles_pct_change"))


def availability(clean: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Share of (camera, minute) cells of each day with at least one event.

    Minutes with data are counted per (camera, day); the expected cells are a
    spine of registry cameras x days between the first and last event day
    (generated by ``sequence``/``explode`` per camera, not a cross join).
    With no events at all the spine is empty.
    """
    reg = registry if registry is not None else camera_registry(clean.sparkSession)
    # one scan: per (camera, day) minute counts, small (cameras x days) and
    # kept for the span and the join
    seen = cut_lineage(clean.groupBy("camera_id", "event_date")
                       .agg(F.count_distinct(F.date_trunc("minute", "event_ts")).alias("minutes_with_data")))
    lo, hi = seen.agg(F.min("event_date"), F.max("event_date")).first()
    days = (F.sequence(F.lit(lo), F.lit(hi), F.expr("INTERVAL 1 DAY")) if lo is not None
            else F.array().cast("array<date>"))
    spine = reg.select("camera_id", "zone", F.explode(days).alias("event_date"))
    # seen grows with the time span: broadcast only behind its row count
    out = join_counted(spine, seen, ["camera_id", "event_date"], "left")
    m = F.coalesce(F.col("minutes_with_data"), F.lit(0).cast("long"))
    return out.select("event_date", "camera_id", "zone", m.alias("minutes_with_data"),
                      F.lit(1440).alias("expected_minutes"), (m / F.lit(1440)).alias("availability"))


def throughput(clean: DataFrame, as_of=None, points: int = 20, bucket_seconds: int = 1) -> DataFrame:
    """Events per bucket for the last ``points`` buckets, zero-filled."""
    b = int(bucket_seconds)
    now = X.ts_value(as_of)
    last = F.timestamp_seconds(F.floor(F.unix_seconds(now) / b) * b)
    first = last - F.expr(f"INTERVAL {(points - 1) * b} SECONDS")
    spark = clean.sparkSession
    spine = spark.range(1).select(
        F.explode(F.sequence(first, last, F.expr(f"INTERVAL {b} SECONDS"))).alias("bucket_start"))
    counts = (clean.filter((F.col("event_ts") >= first)
                           & (F.col("event_ts") < last + F.expr(f"INTERVAL {b} SECONDS")))
              .groupBy(F.timestamp_seconds(F.floor(F.unix_seconds("event_ts") / b) * b).alias("bucket_start"))
              .agg(F.count(F.lit(1)).alias("events")))
    return (spine.join(counts, "bucket_start", "left")
            .select("bucket_start", F.coalesce(F.col("events"), F.lit(0).cast("long")).alias("events")))


def active_anomalies(alerts: DataFrame, as_of=None, windows=(15, 30, 60)) -> DataFrame:
    """Alerts created in the last 15/30/60 minutes by severity and type."""
    now = X.ts_value(as_of)
    age = F.col("created_at")
    win = F.col("window_minutes")
    first = now - F.make_interval(mins=F.lit(max(int(w) for w in windows)))
    # the widest window first: older alerts aren't exploded, nor their days read
    alerts = alerts.filter((age >= first) & (age <= now))
    if "created_date" in alerts.columns:
        alerts = alerts.filter(F.col("created_date").between(F.to_date(first), F.to_date(now)))
    return (alerts.select("severity", "alert_type", "acknowledged_at", "created_at",
                          F.explode(F.array(*[F.lit(int(w)) for w in windows])).alias("window_minutes"))
            .filter((age >= now - F.make_interval(mins=win)) & (age <= now))
            .groupBy("window_minutes", "severity", "alert_type")
            .agg(F.count(F.lit(1)).alias("alerts"),
                 F.count_if(unacknowledged_at(now)).alias("unacknowledged")))


def _bucket(ts: Column, seconds: float) -> Column:
    micros = max(1, int(seconds * 1_000_000))
    return F.timestamp_micros(F.floor(F.unix_micros(ts) / micros) * micros)


def _cutoff(df: DataFrame, n: int, width_s: float, max_buckets: int):
    """Start of the newest time bucket at which the running count reaches n
    (None if the frame has fewer than n rows), and that bucket's row count."""
    width = max(width_s / max_buckets, 1e-6)
    hist = (df.groupBy(_bucket(F.col("event_ts"), width).alias("b")).count()
            .orderBy(F.col("b").desc()).collect())            # <= max_buckets rows
    total = 0
    for r in hist:
        total += r["count"]
        if total >= n:
            return r["b"], r["count"], width
    return None, 0, width


def recent_events(clean: DataFrame, as_of=None, hours: float = 48, n: int = 500_000,
                  cols=None, max_buckets: int = 4096) -> DataFrame:
    """Newest-first events since as_of - hours, capped at ``n`` rows
    (ties: larger event_id first).

    A plain ``orderBy().limit(n)`` merges every partition's top n in one task
    (partitions x n rows).  Instead a per-bucket histogram (at most
    ``max_buckets`` rows to the driver) finds the time cutoff, so the final
    top-n only sees rows from the cutoff bucket on: at most n plus one bucket.
    A boundary bucket holding more than n rows is refined once more.
    """
    from ..schema import FEATURE_COLS
    cols = cols or (FEATURE_COLS + ["camera_id", "event_ts", "event_id"])
    df = _window(clean, as_of, hours * 60).select(*cols)
    order = [F.col("event_ts").desc(), F.col("event_id").desc()]
    start, in_bucket, width = _cutoff(df, n, hours * 3600, max_buckets)
    if start is None:                      # fewer than n rows: all of them
        return df.orderBy(*order)
    if in_bucket > n:                      # refine inside the boundary bucket
        lo = F.lit(start)
        inner = df.filter((F.col("event_ts") >= lo) & (F.col("event_ts") < lo + F.expr(
            f"INTERVAL {max(1, int(width * 1_000_000))} MICROSECONDS")))
        above = df.filter(F.col("event_ts") >= lo + F.expr(
            f"INTERVAL {max(1, int(width * 1_000_000))} MICROSECONDS")).count()
        sub, _, _ = _cutoff(inner, n - above, width, max_buckets)
        start = sub if sub is not None else start
    return df.filter(F.col("event_ts") >= F.lit(start)).orderBy(*order).limit(n)
