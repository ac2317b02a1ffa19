"""SQL text shared by the oracle queries (DuckDB twins of the Spark plans).

The adapter views (``traffic_raw``, ``clean``, ``registry``) come from
``sources.fixtures.ADAPTER_SQL``; these fragments add the alert stand-ins, the
daily summary, window expansion and the contract rules on top.
"""

from __future__ import annotations

import datetime as dt

from ..schema import RAW_FIELDS
from ..sources.fixtures import ADAPTER_SQL
from . import oracle as O

RAW_COLS = ", ".join(RAW_FIELDS)
CLEAN_OUT = RAW_FIELDS + ["speed_index", "congestion_category", "is_peak_hour",
                          "event_date", "event_hour"]

# --- SQL twins of the contract rules (independent spec for the oracle) ---------
RULE_SQL = {
    "camera_id_missing": "camera_id IS NULL",
    "camera_id_pattern": "camera_id IS NOT NULL AND NOT regexp_matches(camera_id, '^CAM_\\d{2}$')",
    "event_ts_invalid": "event_ts IS NULL",
    "location_missing": "location IS NULL",
    "latitude_range": "NOT coalesce(latitude BETWEEN -90 AND 90, false)",
    "longitude_range": "NOT coalesce(longitude BETWEEN -180 AND 180, false)",
    "vehicle_count_range": "NOT coalesce(vehicle_count BETWEEN 0 AND 2000, false)",
    "average_speed_range": "NOT coalesce(average_speed BETWEEN 0 AND 200, false)",
    "congestion_level_enum": "NOT coalesce(congestion_level IN ('LOW','MEDIUM','HIGH','CRITICAL'), false)",
    "congestion_score_range": "NOT coalesce(congestion_score BETWEEN 0 AND 100, false)",
    "critical_below_min_score": "coalesce(congestion_level = 'CRITICAL' AND congestion_score < 75, false)",
    "pedestrian_count_range": "coalesce(pedestrian_count < 0, false)",
    "heavy_vehicle_pct_range": "coalesce(NOT (heavy_vehicle_pct BETWEEN 0 AND 100), false)",
}


def window_sql(bucket: str, n_slides: int, width: str, adapter: str = ADAPTER_SQL) -> str:
    return O.with_adapter(
        f"w AS (SELECT c.*, time_bucket(INTERVAL '{bucket}', event_ts) - (k.k * INTERVAL '{bucket}') AS window_start "
        f"FROM clean c CROSS JOIN range({n_slides}) AS k(k))",
        body=(
            f"SELECT camera_id, location, window_start, window_start + INTERVAL '{width}' AS window_end, "
            f"{O.imean('vehicle_count')} AS avg_vehicle_count, max(vehicle_count) AS max_vehicle_count, "
            "min(vehicle_count) AS min_vehicle_count, "
            f"{O.mean('average_speed')} AS avg_speed, min(average_speed) AS min_speed, "
            f"{O.mean('congestion_score')} AS avg_congestion_score, max(congestion_score) AS max_congestion_score, "
            f"{O.isum('cast(accident_detected as int)')} AS accident_count, count(*) AS event_count, "
            "arg_min(congestion_category, row(event_ts, coalesce(event_id, ''), congestion_score)) AS congestion_category "
            "FROM w GROUP BY camera_id, location, window_start"), adapter=adapter)


LOOKBACK_MIN = 1440
NOW_CTE = "nowt AS (SELECT max(event_ts) AS now FROM clean)"
PAST = dt.timedelta(hours=36)
PAST_CTE = "nowt AS (SELECT max(event_ts) - INTERVAL 36 HOUR AS now FROM clean)"
# an event without an id: the md5 of its readings (alerts.reading_key)
UNNAMED_KEY = ("'x' || md5(concat_ws('|', camera_id, cast(epoch_us(event_ts) as varchar), "
               "cast(vehicle_count as varchar), cast(average_speed as varchar), cast(congestion_score as varchar), "
               "cast(pedestrian_count as varchar), cast(heavy_vehicle_pct as varchar), "
               "cast(coalesce(accident_detected, false) as varchar)))")
STATUS_SQL = ("CASE WHEN {s} >= 75 THEN 'critical' WHEN {s} >= 50 THEN 'high' "
              "WHEN {s} >= 25 THEN 'medium' ELSE 'normal' END")
CATEGORY_SQL = ("CASE WHEN {s} >= 75 THEN 'CRITICAL' WHEN {s} >= 50 THEN 'HIGH' "
                "WHEN {s} >= 25 THEN 'MEDIUM' ELSE 'LOW' END")
LATEST_CTE = (
    "lt AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY camera_id "
    "ORDER BY event_ts DESC, event_id DESC) AS rn FROM clean c, nowt "
    f"WHERE c.event_ts >= nowt.now - INTERVAL {LOOKBACK_MIN} MINUTE AND c.event_ts <= nowt.now) WHERE rn = 1)")


ALERTS_SQL = (
    "feat AS (SELECT * FROM clean WHERE vehicle_count IS NOT NULL AND average_speed IS NOT NULL "
    "AND congestion_score IS NOT NULL AND pedestrian_count IS NOT NULL AND heavy_vehicle_pct IS NOT NULL "
    "AND event_hour IS NOT NULL)",
    f"bl AS (SELECT camera_id, {O.imean('vehicle_count')} AS baseline_vehicle_count FROM feat GROUP BY camera_id)",
    "scored AS (SELECT *, cast((cast(event_id as bigint) * 7919) % 1000 as double) / 1000 AS anomaly_score FROM feat)",
    "anom AS (SELECT s.*, coalesce(b.baseline_vehicle_count, cast(100.0 as double)) AS b0 FROM scored s "
    "LEFT JOIN bl b ON s.camera_id = b.camera_id WHERE s.anomaly_score >= 0.85)",
    f"cls AS (SELECT *, {O.rnd('(cast(vehicle_count as double) - b0) / (b0 + cast(1.0 as double)) * cast(100.0 as double)', 1)} "
    "AS pct_above_baseline FROM anom)",
    "typed AS (SELECT *, CASE WHEN average_speed < 10 AND coalesce(accident_detected, false) THEN 'ACCIDENT' "
    "WHEN pct_above_baseline >= 200 THEN 'TRAFFIC_SPIKE' WHEN average_speed < 10 THEN 'LOW_SPEED' "
    "ELSE 'UNUSUAL_COUNT' END AS alert_type FROM cls)",
    "recs AS (SELECT camera_id || '_' || cast(cast(floor(epoch(event_ts)) as bigint) as varchar) || '_' || alert_type "
    "|| '_' || event_id AS alert_id, camera_id, alert_type, "
    "CASE WHEN alert_type IN ('ACCIDENT', 'TRAFFIC_SPIKE') THEN 'CRITICAL' ELSE 'WARNING' END AS severity, "
    f"{O.rnd('anomaly_score', 4)} AS anomaly_score, "
    "CASE alert_type "
    "WHEN 'ACCIDENT' THEN 'Accident pattern detected on ' || camera_id || '. Speed dropped to ' "
    "|| cast(average_speed as varchar) || ' km/h with accident_detected=True.' "
    "WHEN 'TRAFFIC_SPIKE' THEN 'Anomaly detected: ' || camera_id || ' has ' || cast(pct_above_baseline as varchar) "
    "|| '% higher vehicle count than normal (' || cast(vehicle_count as varchar) || ' vs baseline ' "
    "|| cast(cast(round_even(b0, 0) as bigint) as varchar) || ').' "
    "WHEN 'LOW_SPEED' THEN camera_id || ' reporting critically low speed: ' || cast(average_speed as varchar) "
    "|| ' km/h. Possible blockage.' "
    "ELSE 'Unusual vehicle count on ' || camera_id || ': ' || cast(vehicle_count as varchar) "
    "|| ' (anomaly score ' || printf('%.3f', anomaly_score) || ').' END AS message, "
    f"event_ts AS created_at, {O.rnd('b0', 2)} AS baseline_vehicle_count, vehicle_count AS current_vehicle_count, "
    "pct_above_baseline, event_id FROM typed)",
    "atbl AS (SELECT *, CASE WHEN cast(event_id as bigint) % 5 = 0 THEN created_at + INTERVAL 1 HOUR END "
    "AS acknowledged_at FROM (SELECT DISTINCT * FROM recs))",
    "alerts_tbl AS (SELECT *, acknowledged_at IS NOT NULL AS acknowledged FROM atbl)",
)


DAILY_CTES = (
    "dcnt AS (SELECT event_date, camera_id, location, event_hour, count(*) AS n FROM clean "
    "GROUP BY event_date, camera_id, location, event_hour)",
    "dpk AS (SELECT event_date, camera_id, location, event_hour AS peak_hour FROM (SELECT *, row_number() OVER "
    "(PARTITION BY event_date, camera_id, location ORDER BY n DESC, event_hour) AS rn FROM dcnt) WHERE rn = 1)",
    "daily AS (SELECT c.event_date AS summary_date, c.camera_id, c.location, count(*) AS total_events, "
    f"{O.imean('c.vehicle_count')} AS avg_vehicle_count, max(c.vehicle_count) AS max_vehicle_count, "
    f"{O.mean('c.average_speed')} AS avg_speed, min(c.average_speed) AS min_speed, "
    f"{O.isum('cast(c.accident_detected as int)')} AS total_accidents, "
    f"{O.mean('c.congestion_score')} AS avg_congestion_score, any_value(p.peak_hour) AS peak_hour "
    "FROM clean c JOIN dpk p ON c.event_date = p.event_date AND c.camera_id = p.camera_id "
    "AND c.location IS NOT DISTINCT FROM p.location GROUP BY c.event_date, c.camera_id, c.location)",
)
