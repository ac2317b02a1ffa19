"""Registered queries: ingest, validation, enrichment, windows, data quality, stream replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import windows as W
from ..schema import EVENT_FIELDS
from ..sources.fixtures import ADAPTER_SQL, ROUGH_SQL
from . import oracle as O
from . import tables as TB
from .registry import register
from .sqlviews import CLEAN_OUT, RAW_COLS, RULE_SQL, window_sql

# ============================================================================
# Ingest, validation, enrichment
# ============================================================================

@register("decode_events", O.with_adapter(body=f"SELECT {RAW_COLS} FROM traffic_raw"))
def q_decode_events(spark, sf_dir):
    """Kafka-shaped JSON records -> typed raw events."""
    return TB.decoded(spark, sf_dir, keep_value=False)


@register("validate_events", O.with_adapter(
    body=f"SELECT {RAW_COLS} FROM traffic_raw WHERE camera_id IS NOT NULL "
         "AND vehicle_count BETWEEN 0 AND 2000 AND average_speed BETWEEN 0 AND 200 "
         "AND congestion_score BETWEEN 0 AND 100 AND event_ts IS NOT NULL "
         "AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"))
def q_validate_events(spark, sf_dir):
    """Q1: validity filter over the raw zone."""
    return Q.validate(TB.raw(spark, sf_dir))


@register("contract_violations", O.with_adapter(body="\nUNION ALL\n".join(
    f"SELECT event_id, kafka_offset, '{r}' AS rule FROM traffic_raw WHERE {c}"
    for r, c in RULE_SQL.items())))
def q_contract_violations(spark, sf_dir):
    """Q2: one row per (delivered event, failed contract rule)."""
    v = Q.violations(TB.raw(spark, sf_dir))
    return v.select("event_id", "kafka_offset", F.explode("violations").alias("rule"))


def _reject_sql() -> str:
    flags = ", ".join(f"({c}) AS {r}" for r, c in RULE_SQL.items())
    any_c = " OR ".join(f"({c})" for c in RULE_SQL.values())
    parts = [f"SELECT '{r}' AS rule, cast(count_if({r}) as bigint) AS rejected_rows, count(*) AS total_rows "
             "FROM flags" for r in RULE_SQL]
    parts.append("SELECT 'any' AS rule, cast(count_if(any_bad) as bigint) AS rejected_rows, "
                 "count(*) AS total_rows FROM flags")
    return O.with_adapter(
        f"flags AS (SELECT {flags}, ({any_c}) AS any_bad FROM traffic_raw)",
        f"u AS ({' UNION ALL '.join(parts)})",
        body="SELECT rule, rejected_rows, total_rows, rejected_rows / total_rows AS reject_rate FROM u")


@register("reject_stats", _reject_sql())
def q_reject_stats(spark, sf_dir):
    """Q3: per-rule reject counts and rate."""
    return Q.reject_stats(TB.raw(spark, sf_dir))


@register("quarantine_events", O.with_adapter(
    body=f"SELECT {RAW_COLS} FROM traffic_raw WHERE " + " OR ".join(f"({c})" for c in RULE_SQL.values())))
def q_quarantine(spark, sf_dir):
    """Q3: the quarantined side of the good/bad split."""
    _, bad = Q.split_quarantine(TB.raw(spark, sf_dir))
    return bad.drop("violations")


@register("apply_defaults", O.with_adapter(body=(
    "SELECT event_id, kafka_offset, coalesce(accident_detected, false) AS accident_detected, "
    "coalesce(pedestrian_count, 0) AS pedestrian_count, "
    "coalesce(heavy_vehicle_pct, cast(0.0 as double)) AS heavy_vehicle_pct, "
    "coalesce(producer_version, '2.4.1') AS producer_version, coalesce(schema_version, '1.0') AS schema_version, "
    f"{O.rnd('congestion_score', 2)} AS congestion_score FROM traffic_raw")))
def q_apply_defaults(spark, sf_dir):
    """Q4/Q5: contract defaults and the 2-dp score."""
    d = Q.apply_defaults(TB.decoded(spark, sf_dir))
    return d.select("event_id", "kafka_offset", "accident_detected", "pedestrian_count",
                    "heavy_vehicle_pct", "producer_version", "schema_version", "congestion_score")


@register("enrich_events", O.with_adapter(body=(
    f"SELECT {RAW_COLS}, {O.speed_index()} AS speed_index, congestion_category, is_peak_hour, "
    "event_date, event_hour FROM clean")))
def q_enrich_events(spark, sf_dir):
    """The clean zone (validated + derived columns)."""
    return TB.clean(spark, sf_dir).select(*CLEAN_OUT)


# ============================================================================
# Windows
# ============================================================================

@register("sliding_metrics", window_sql("1 minute", 5, "5 minutes"))
def q_sliding_metrics(spark, sf_dir):
    """5-minute windows sliding by 1 minute per camera."""
    return W.sliding_metrics(TB.clean(spark, sf_dir))


@register("tumbling_metrics", window_sql("1 hour", 1, "1 hour"))
def q_tumbling_metrics(spark, sf_dir):
    """Hourly tumbling windows per camera."""
    return W.tumbling_metrics(TB.clean(spark, sf_dir), window="1 hour")


# ============================================================================
# Data quality
# ============================================================================

_DQ_RATES = (
    "((count_if(camera_id IS NULL) / count(*) + count_if(vehicle_count IS NULL) / count(*)) "
    "+ count_if(average_speed IS NULL) / count(*)) / 3 AS nr, "
    "count_if(vehicle_count < 0 OR vehicle_count > 2000) / count(*) AS oor, "
    "(count(*) - count(DISTINCT event_id) - max(cast(event_id IS NULL as int))) / count(*) AS dr")


@register("dq_stats", O.with_adapter(
    f"s AS (SELECT cast(event_ts as date) AS event_date, count(*) AS total, {_DQ_RATES} "
    "FROM traffic_raw GROUP BY 1)",
    body=(f"SELECT event_date, total, {O.rnd('nr', 4)} AS null_rate, {O.rnd('oor', 4)} AS out_of_range, "
          f"{O.rnd('dr', 4)} AS dup_rate FROM s")))
def q_dq_stats(spark, sf_dir):
    """DQ statistics per event date of the raw zone."""
    return Q.dq_stats(TB.raw(spark, sf_dir)).select(
        "event_date", "total", "null_rate", "out_of_range", "dup_rate")


@register("dq_stats_bitmap", O.with_adapter(
    f"s AS (SELECT cast(event_ts as date) AS event_date, count(*) AS total, {_DQ_RATES} "
    "FROM traffic_raw GROUP BY 1)",
    body=(f"SELECT event_date, total, {O.rnd('nr', 4)} AS null_rate, {O.rnd('oor', 4)} AS out_of_range, "
          f"{O.rnd('dr', 4)} AS dup_rate FROM s")))
def q_dq_stats_bitmap(spark, sf_dir):
    """The same statistics with distinct ids counted in merged bitmaps."""
    return Q.dq_stats(TB.raw(spark, sf_dir), bitmap=True).select(
        "event_date", "total", "null_rate", "out_of_range", "dup_rate")


@register("dq_gate", O.with_adapter(
    f"s AS (SELECT cast(event_ts as date) AS event_date, count(*) AS total, {_DQ_RATES} "
    "FROM traffic_raw GROUP BY 1)",
    body=(f"SELECT event_date, total, {O.rnd('nr', 4)} AS null_rate, {O.rnd('oor', 4)} AS out_of_range, "
          f"{O.rnd('dr', 4)} AS dup_rate, (nr + oor + dr) / 3 AS bad_pct, "
          "CASE WHEN (nr + oor + dr) / 3 < 0.05 THEN 'quality_pass' ELSE 'quality_fail' END AS decision "
          "FROM s")))
def q_dq_gate(spark, sf_dir):
    """A10: the DQ gate decision per event date of the raw zone."""
    return Q.dq_gate(Q.dq_stats(TB.raw(spark, sf_dir)))


def _z(c: str, mean: str, std: str) -> str:
    return f"coalesce(abs(CASE WHEN {std} > 0 THEN ({c} - {mean}) / {std} ELSE 0.0 END) > 3, false)"


def _zscore_sql(adapter: str = ADAPTER_SQL) -> str:
    return O.with_adapter(
        "st AS (SELECT camera_id, "
        f"{O.imean('vehicle_count')} AS vc_mean, {O.pop_std('vehicle_count', True)} AS vc_std, "
        f"{O.mean('average_speed')} AS sp_mean, {O.pop_std('average_speed', False)} AS sp_std "
        "FROM clean GROUP BY camera_id)",
        "j AS (SELECT c.camera_id, "
        f"{_z('c.vehicle_count', 'st.vc_mean', 'st.vc_std')} AS vo, "
        f"{_z('c.average_speed', 'st.sp_mean', 'st.sp_std')} AS so "
        "FROM clean c JOIN st ON c.camera_id = st.camera_id)",
        "g AS (SELECT camera_id, count(*) AS events, cast(count_if(vo) as bigint) AS vehicle_outliers, "
        "cast(count_if(so) as bigint) AS speed_outliers, cast(count_if(vo OR so) as bigint) AS outlier_rows "
        "FROM j GROUP BY camera_id)",
        body=("SELECT camera_id, events, vehicle_outliers, speed_outliers, outlier_rows, "
              "outlier_rows / events AS outlier_rate, outlier_rows / events <= 0.05 AS zscore_pass FROM g"), adapter=adapter)


@register("zscore_outliers", _zscore_sql())
def q_zscore_outliers(spark, sf_dir):
    """Per-camera 3-sigma outlier share and gate."""
    return Q.zscore_outliers(TB.clean(spark, sf_dir))


@register("zscore_outliers_rough", _zscore_sql(ROUGH_SQL))
def q_zscore_outliers_rough(spark, sf_dir):
    """A11 where one camera's speed never changes (its z-score is 0)."""
    return Q.zscore_outliers(TB.rough_clean(spark, sf_dir))


@register("dedup_events", O.with_adapter(body=(
    f"SELECT {RAW_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY event_id "
    "ORDER BY kafka_ingest_ts NULLS FIRST, kafka_offset NULLS FIRST) AS rn FROM traffic_raw) WHERE rn = 1")))
def q_dedup_events(spark, sf_dir):
    """One row per event id, earliest ingest."""
    return Q.dedup_events(TB.raw(spark, sf_dir))


@register("sliding_metrics_rough", window_sql("1 minute", 5, "5 minutes", ROUGH_SQL))
def q_sliding_metrics_rough(spark, sf_dir):
    """T2/A1 over events without ids and values of seven decimals."""
    return W.sliding_metrics(TB.rough_clean(spark, sf_dir))


@register("dedup_events_rough", O.with_adapter(
    "k AS (SELECT *, CASE WHEN event_id IS NOT NULL THEN event_id "
    "WHEN kafka_offset IS NOT NULL THEN '#' || kafka_partition || ':' || kafka_offset "
    "ELSE '#' || cast(traffic_raw as varchar) END AS id FROM traffic_raw)",
    body=(f"SELECT {RAW_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY kafka_ingest_ts NULLS FIRST, "
          "kafka_partition NULLS FIRST, kafka_offset NULLS FIRST) AS rn FROM k) WHERE rn = 1"),
    adapter=ROUGH_SQL))
def q_dedup_events_rough(spark, sf_dir):
    """A12 where ids and offsets are missing: by id, else by delivery coordinates, else by the whole row."""
    return Q.dedup_events(TB.rough(spark, sf_dir))


@register("stream_sliding_metrics", window_sql("1 minute", 5, "5 minutes").replace(
    "FROM w GROUP BY camera_id, location, window_start",
    "FROM w GROUP BY camera_id, location, window_start "
    "HAVING window_start + INTERVAL '5 minutes' <= (SELECT max(event_ts) FROM clean) - INTERVAL '10 minutes'"))
def q_stream_sliding_metrics(spark, sf_dir):
    """The watermarked streaming window query over a time-ordered
    file replay of the events; equals the batch windows up to the watermark."""
    from .replay import replay_sliding_metrics
    return replay_sliding_metrics(spark, TB.raw(spark, sf_dir))


@register("stream_dedup_events", O.with_adapter(body=(
    "SELECT DISTINCT " + ", ".join(EVENT_FIELDS) + f", {O.speed_index()} AS speed_index, "
    "congestion_category, is_peak_hour, event_date, event_hour FROM clean")))
def q_stream_dedup_events(spark, sf_dir):
    """The clean stream over a time-ordered replay, de-duplicated by
    event id within the watermark (each re-delivered event kept once)."""
    from .replay import replay_clean_dedup
    return replay_clean_dedup(spark, TB.raw(spark, sf_dir))


@register("stream_dedup_late_events", O.with_adapter(body=(
    "SELECT DISTINCT " + ", ".join(EVENT_FIELDS) + f", {O.speed_index()} AS speed_index, "
    "congestion_category, is_peak_hour, event_date, event_hour FROM clean"), adapter=ROUGH_SQL))
def q_stream_dedup_late_events(spark, sf_dir):
    """T6 where second deliveries come 20 s, 20 min or 6 days late, the last ones in a
    later micro-batch behind the watermark, and some events have no id."""
    from .replay import replay_clean_dedup
    return replay_clean_dedup(spark, TB.rough(spark, sf_dir))
