"""Registered queries: the operational API (serving) and zone freshness."""

from __future__ import annotations

from ..operators import serving as S
from . import oracle as O
from . import tables as TB
from .registry import register
from .sqlviews import ALERTS_SQL, CATEGORY_SQL, LATEST_CTE, LOOKBACK_MIN, NOW_CTE, PAST, PAST_CTE, STATUS_SQL

# ============================================================================
# Serving queries (as_of = newest event time; 24 h look-back at this density)
# ============================================================================

@register("live_metrics", O.with_adapter(NOW_CTE, LATEST_CTE, body=(
    "SELECT camera_id, location, vehicle_count, average_speed, congestion_score, congestion_level, "
    f"accident_detected, event_ts, {STATUS_SQL.format(s='congestion_score')} AS status FROM lt")))
def q_live_metrics(spark, sf_dir):
    """Latest reading per camera in the look-back, with status."""
    c, now = TB.clean_and_now(spark, sf_dir)
    return S.live_metrics(c, as_of=now, minutes=LOOKBACK_MIN)


_SUMMARY_BODY = (

    "SELECT count(*) AS total_events_today, count(DISTINCT camera_id) AS active_cameras, "
    "(SELECT count(*) FROM registry) AS total_cameras, "
    f"{O.rnd('coalesce(' + O.mean('average_speed') + ', cast(0.0 as double))', 1)} AS avg_speed_kmh, "
    f"{O.rnd('coalesce(' + O.mean('congestion_score') + ', cast(0.0 as double))', 1)} AS avg_congestion_score, "
    "(SELECT count(*) FROM alerts_tbl a, nowt n WHERE a.created_at >= n.now - INTERVAL 60 MINUTE "
    "AND a.created_at <= n.now AND (a.acknowledged_at IS NULL OR a.acknowledged_at > n.now)) AS active_anomalies, "
    + O.rnd("cast(100.0 as double) * (SELECT count(*) FROM (SELECT DISTINCT c.camera_id, "
            "date_trunc('minute', c.event_ts) FROM clean c JOIN registry r ON c.camera_id = r.camera_id, nowt n "
            "WHERE c.event_date = cast(n.now as date) AND c.event_ts <= n.now)) / ((SELECT count(*) FROM registry) * "
            "(hour(nowt.now) * 60 + minute(nowt.now) + 1))", 1) + " AS pipeline_sla_pct, "
    f"{O.rnd('cast(count_if(event_ts >= nowt.now - INTERVAL 1 SECOND) as double)', 1)} AS events_per_second, "
    "nowt.now AS last_updated "
    "FROM clean, nowt WHERE event_date = cast(nowt.now as date) AND event_ts <= nowt.now GROUP BY nowt.now")


@register("platform_summary", O.with_adapter(NOW_CTE, *ALERTS_SQL, body=_SUMMARY_BODY))
def q_platform_summary(spark, sf_dir):
    """V2: KPI row for the as_of day."""
    c, now = TB.clean_and_now(spark, sf_dir)
    return S.platform_summary(c, TB.alerts_table(spark, sf_dir), TB.registry(spark), as_of=now)


@register("platform_summary_past", O.with_adapter(PAST_CTE, *ALERTS_SQL, body=_SUMMARY_BODY))
def q_platform_summary_past(spark, sf_dir):
    """V2: KPI row as of 36 hours before the newest event; later events don't count."""
    c, now = TB.clean_and_now(spark, sf_dir)
    return S.platform_summary(c, TB.alerts_table(spark, sf_dir), TB.registry(spark), as_of=now - PAST)


@register("hourly_profile", O.with_adapter(body=(
    f"SELECT event_date, event_hour, {O.imean('vehicle_count')} AS avg_vehicle_count, "
    f"max(vehicle_count) AS max_vehicle_count, {O.mean('average_speed')} AS avg_speed, "
    f"{O.mean('congestion_score')} AS avg_congestion, count(*) AS event_count "
    "FROM clean GROUP BY event_date, event_hour")))
def q_hourly_profile(spark, sf_dir):
    """V4/A3: hourly averages per day."""
    return S.hourly_profile(TB.clean(spark, sf_dir))


_CAMS_BODY = (
    "SELECT r.camera_id, r.location, r.latitude, r.longitude, r.zone, true AS active, lt.vehicle_count, "
    "lt.average_speed, lt.congestion_score, lt.event_ts, CASE WHEN lt.event_ts IS NULL THEN 'offline' ELSE "
    + STATUS_SQL.format(s="lt.congestion_score") + " END AS status "
    "FROM registry r LEFT JOIN lt ON r.camera_id = lt.camera_id")


@register("cameras_status", O.with_adapter(NOW_CTE, LATEST_CTE, body=_CAMS_BODY))
def q_cameras_status(spark, sf_dir):
    """Registry cameras with current status (offline when silent)."""
    c, now = TB.clean_and_now(spark, sf_dir)
    return S.cameras_status(c, TB.registry(spark), as_of=now, minutes=LOOKBACK_MIN)


def _detail_sql(now_cte: str) -> str:
    return O.with_adapter(
        now_cte, LATEST_CTE, f"cs AS ({_CAMS_BODY})",
        "td AS (SELECT camera_id, count(*) AS events_today, "
        f"{O.imean('vehicle_count')} AS avg_vehicle_count_today, max(vehicle_count) AS max_vehicle_count_today, "
        f"{O.mean('average_speed')} AS avg_speed_today, {O.mean('congestion_score')} AS avg_congestion_today "
        "FROM clean, nowt WHERE event_date = cast(nowt.now as date) AND event_ts <= nowt.now GROUP BY camera_id)",
        body=("SELECT cs.*, coalesce(td.events_today, 0) AS events_today, td.avg_vehicle_count_today, "
              "td.max_vehicle_count_today, td.avg_speed_today, td.avg_congestion_today "
              "FROM cs LEFT JOIN td ON cs.camera_id = td.camera_id"))


@register("camera_detail", _detail_sql(NOW_CTE))
def q_camera_detail(spark, sf_dir):
    """V6: per-camera detail (registry + latest + today's aggregates)."""
    c, now = TB.clean_and_now(spark, sf_dir)
    return S.camera_detail(c, TB.registry(spark), as_of=now, minutes=LOOKBACK_MIN)


@register("camera_detail_past", _detail_sql(PAST_CTE))
def q_camera_detail_past(spark, sf_dir):
    """V6 as of 36 hours before the newest event."""
    c, now = TB.clean_and_now(spark, sf_dir)
    return S.camera_detail(c, TB.registry(spark), as_of=now - PAST, minutes=LOOKBACK_MIN)


_ZONE_CTE = ("z AS (SELECT r.zone, " + O.mean("c.congestion_score") + " AS avg_congestion_score, "
             "count(*) AS event_count, count(DISTINCT c.camera_id) AS cameras "
             "FROM clean c JOIN registry r ON c.camera_id = r.camera_id GROUP BY r.zone)")


@register("zone_congestion", O.with_adapter(_ZONE_CTE, body=(
    "SELECT zone, avg_congestion_score, event_count, cameras, "
    + CATEGORY_SQL.format(s="avg_congestion_score") + " AS congestion_level FROM z")))
def q_zone_congestion(spark, sf_dir):
    """Mean congestion per zone and its level."""
    return S.zone_congestion(TB.clean(spark, sf_dir), TB.registry(spark))


@register("zone_level_counts", O.with_adapter(_ZONE_CTE, body=(
    "SELECT " + CATEGORY_SQL.format(s="avg_congestion_score") + " AS congestion_level, count(*) AS zones "
    "FROM z GROUP BY 1")))
def q_zone_level_counts(spark, sf_dir):
    """V7: number of zones per congestion level."""
    return S.zone_level_counts(S.zone_congestion(TB.clean(spark, sf_dir), TB.registry(spark)))


@register("peak_hours", O.with_adapter(
    "h AS (SELECT event_hour, cast(sum(vehicle_count) as bigint) AS total_vehicles, count(*) AS event_count "
    "FROM clean GROUP BY event_hour)",
    "pk AS (SELECT event_hour AS peak FROM h ORDER BY total_vehicles DESC, event_hour ASC LIMIT 1)",
    body=("SELECT h.event_hour, total_vehicles, event_count, h.event_hour = pk.peak AS is_peak, "
          "printf('%02d:00-%02d:00', h.event_hour, (h.event_hour + 1) % 24) AS hour_band FROM h, pk")))
def q_peak_hours(spark, sf_dir):
    """V8: vehicles by hour of day and the peak hour."""
    return S.peak_hours(TB.clean(spark, sf_dir))


def _pct_sql(c: str, p: str) -> str:
    inner = (f"(cast({c} as double) - cast({p} as double)) * cast(100.0 as double) / cast({p} as double)")
    return f"CASE WHEN {p} <> 0 THEN {O.rnd(inner, 1)} END"


@register("hour_over_hour", O.with_adapter(
    "h AS (SELECT date_trunc('hour', event_ts) AS hour_start, count(*) AS event_count, "
    "cast(sum(vehicle_count) as bigint) AS total_vehicles FROM clean GROUP BY 1)",
    body=("SELECT h.hour_start, h.event_count, h.total_vehicles, p.event_count AS prev_event_count, "
          "p.total_vehicles AS prev_total_vehicles, "
          f"{_pct_sql('h.event_count', 'p.event_count')} AS events_pct_change, "
          f"{_pct_sql('h.total_vehicles', 'p.total_vehicles')} AS vehicles_pct_change "
          "FROM h LEFT JOIN h p ON p.hour_start + INTERVAL 1 HOUR = h.hour_start")))
def q_hour_over_hour(spark, sf_dir):
    """Hourly totals vs the previous clock hour."""
    return S.hour_over_hour(TB.clean(spark, sf_dir))


@register("availability", O.with_adapter(
    "days AS (SELECT cast(unnest(generate_series(cast(min(event_date) as timestamp), "
    "cast(max(event_date) as timestamp), INTERVAL 1 DAY)) as date) AS d FROM clean)",
    "seen AS (SELECT camera_id, event_date, count(DISTINCT date_trunc('minute', event_ts)) AS m "
    "FROM clean GROUP BY camera_id, event_date)",
    body=("SELECT days.d AS event_date, r.camera_id, r.zone, coalesce(seen.m, 0) AS minutes_with_data, "
          "1440 AS expected_minutes, coalesce(seen.m, 0) / 1440 AS availability "
          "FROM registry r CROSS JOIN days LEFT JOIN seen ON seen.camera_id = r.camera_id "
          "AND seen.event_date = days.d")))
def q_availability(spark, sf_dir):
    """Share of (camera, minute) cells with data per day."""
    return S.availability(TB.clean(spark, sf_dir), TB.registry(spark))


@register("throughput", O.with_adapter(
    NOW_CTE,
    "sp AS (SELECT unnest(generate_series(time_bucket(INTERVAL 60 SECOND, now) - INTERVAL 86340 SECOND, "
    "time_bucket(INTERVAL 60 SECOND, now), INTERVAL 60 SECOND)) AS bucket_start FROM nowt)",
    "cnt AS (SELECT time_bucket(INTERVAL 60 SECOND, event_ts) AS bucket_start, count(*) AS events "
    "FROM clean GROUP BY 1)",
    body="SELECT sp.bucket_start, coalesce(cnt.events, 0) AS events FROM sp LEFT JOIN cnt USING (bucket_start)"))
def q_throughput(spark, sf_dir):
    """Zero-filled per-minute event counts for the last 24 h."""
    c, now = TB.clean_and_now(spark, sf_dir)
    return S.throughput(c, as_of=now, points=1440, bucket_seconds=60)


@register("recent_events", O.with_adapter(NOW_CTE, body=(
    "SELECT vehicle_count, average_speed, congestion_score, pedestrian_count, heavy_vehicle_pct, event_hour, "
    "camera_id, event_ts, event_id FROM clean, nowt WHERE event_ts >= now - INTERVAL 2880 MINUTE "
    "AND event_ts <= now ORDER BY event_ts DESC, event_id DESC LIMIT 500000")))
def q_recent_events(spark, sf_dir):
    """Newest-first scan of the last 48 h, capped at 500,000 rows."""
    c, now = TB.clean_and_now(spark, sf_dir)
    return S.recent_events(c, as_of=now, hours=48, n=500_000)


def _zones(spark, sf_dir, pipeline_ts=None):
    from pyspark.sql import functions as F

    from ..operators.windows import sliding_metrics
    clean = TB.clean(spark, sf_dir, processing_time=pipeline_ts is None)
    if pipeline_ts is not None:
        clean = clean.withColumn("pipeline_ts", F.lit(pipeline_ts).cast("timestamp"))
    analytics = sliding_metrics(clean).withColumnRenamed("window_end", "event_ts")
    return {"raw": TB.raw(spark, sf_dir), "clean": clean, "analytics": analytics}


def _percentile_sql(p: float) -> str:
    return (f"(SELECT cast(min(bucket) as double) FROM (SELECT bucket, sum(n) OVER (ORDER BY bucket) AS seen, "
            f"sum(n) OVER () AS total FROM h) WHERE seen >= ceil(total * cast({p} as double)))")


@register("zone_freshness", O.with_adapter(
    NOW_CTE,
    "aw AS (SELECT DISTINCT camera_id, location, time_bucket(INTERVAL '1 minute', event_ts) "
    "- (k.k * INTERVAL '1 minute') AS window_start FROM clean CROSS JOIN range(5) AS k(k))",
    "ms AS (SELECT (epoch_us(now) - epoch_us(event_ts)) // 1000 AS v FROM clean, nowt)",
    "h AS (SELECT v - v % cast(pow(2, greatest(length(bin(v)) - 7, 0)) as bigint) AS bucket, count(*) AS n "
    "FROM ms GROUP BY 1)",
    "z AS (SELECT 'raw' AS component, count(*) AS rows, max(event_ts) AS max_event_ts, "
    "cast(NULL as double) AS latency_ms, cast(NULL as double) AS p99_latency_ms FROM traffic_raw "
    f"UNION ALL SELECT 'clean', count(*), max(event_ts), {_percentile_sql(0.5)}, {_percentile_sql(0.99)} FROM clean "
    "UNION ALL SELECT 'analytics', count(*), max(window_start) + INTERVAL 5 MINUTE, NULL, NULL FROM aw)",
    "l AS (SELECT z.*, cast(epoch_us(now) - epoch_us(max_event_ts) as double) / cast(1000000.0 as double) "
    "AS lag_seconds, now AS logged_at FROM z, nowt)",
    body=("SELECT component, CASE WHEN max_event_ts IS NULL OR lag_seconds > 600 THEN 'down' "
          "WHEN lag_seconds > 60 THEN 'degraded' ELSE 'running' END AS status, latency_ms, p99_latency_ms, rows, "
          "max_event_ts, lag_seconds, logged_at FROM l")))
def q_zone_freshness(spark, sf_dir):
    """Freshness, lag percentiles and status of the raw, clean and analytics
    zones; clean rows are taken to be processed at the newest event's time."""
    from ..streaming.health import zone_freshness
    now = TB.as_of(TB.clean(spark, sf_dir))
    return zone_freshness(_zones(spark, sf_dir, now), as_of=now).drop("details")


@register("zone_lag", O.with_adapter(
    NOW_CTE,
    "aw AS (SELECT DISTINCT camera_id, location, time_bucket(INTERVAL '1 minute', event_ts) "
    "- (k.k * INTERVAL '1 minute') AS window_start FROM clean CROSS JOIN range(5) AS k(k))",
    "z AS (SELECT 'raw' AS component, count(*) AS rows, max(event_ts) AS max_event_ts FROM traffic_raw "
    "UNION ALL SELECT 'clean', count(*), max(event_ts) FROM clean "
    "UNION ALL SELECT 'analytics', count(*), max(window_start) + INTERVAL 5 MINUTE FROM aw)",
    "l AS (SELECT z.*, cast(epoch_us(now) - epoch_us(max_event_ts) as double) / cast(1000000.0 as double) "
    "AS lag_seconds FROM z, nowt)",
    body=("SELECT component, CASE WHEN max_event_ts IS NULL OR lag_seconds > 600 THEN 'down' "
          "WHEN lag_seconds > 60 THEN 'degraded' ELSE 'running' END AS status, rows, max_event_ts, lag_seconds FROM l")))
def q_zone_lag(spark, sf_dir):
    """The columns of zone freshness that do not depend on the processing time."""
    from ..streaming.health import zone_freshness
    zones = _zones(spark, sf_dir)
    return zone_freshness(zones, as_of=TB.as_of(zones["clean"])) \
        .select("component", "status", "rows", "max_event_ts", "lag_seconds")
