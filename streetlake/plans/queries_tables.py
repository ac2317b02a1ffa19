"""Registered queries: daily close, alerts, isolation forest, dimension and table maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.registry import upsert_registry
from ..operators import alerts as A
from ..operators import daily as D
from ..operators import serving as S
from ..sources.fixtures import ADAPTER_SQL, ROUGH_SQL
from . import oracle as O
from . import tables as TB
from .registry import register
from .sqlviews import ALERTS_SQL, CLEAN_OUT, DAILY_CTES, NOW_CTE, RAW_COLS, UNNAMED_KEY

# ============================================================================
# Daily close
# ============================================================================

@register("daily_summary", O.with_adapter(*DAILY_CTES, body="SELECT * FROM daily"))
def q_daily_summary(spark, sf_dir):
    """A2: per day and camera summary with peak hour."""
    return D.daily_summary(TB.clean(spark, sf_dir))


def _nz(x: str) -> str:
    return f"CASE WHEN {x} <> 0 THEN {O.rnd(x, 1)} END"


@register("daily_report", O.with_adapter(*DAILY_CTES, body=(
    "SELECT summary_date AS date, count(DISTINCT camera_id) AS cameras, "
    "cast(sum(total_events) as bigint) AS total_events, "
    f"{_nz('avg(avg_vehicle_count)')} AS avg_vehicles, {_nz('avg(avg_speed)')} AS avg_speed_kmh, "
    "cast(sum(total_accidents) as bigint) AS accidents, "
    f"{_nz('avg(avg_congestion_score)')} AS avg_congestion FROM daily GROUP BY summary_date")))
def q_daily_report(spark, sf_dir):
    """V9/A5: daily report rows over the summaries."""
    return D.daily_report(D.daily_summary(TB.clean(spark, sf_dir)))


# ============================================================================
# Alerts
# ============================================================================

@register("baselines", O.with_adapter(*ALERTS_SQL[:2], body="SELECT * FROM bl"))
def q_baselines(spark, sf_dir):
    """Per-camera vehicle baseline."""
    return A.baselines(TB.clean(spark, sf_dir))


@register("classify_alerts", O.with_adapter(*ALERTS_SQL[:6], body=(
    "SELECT event_id, kafka_offset, camera_id, anomaly_score, pct_above_baseline, alert_type, "
    "CASE WHEN alert_type IN ('ACCIDENT', 'TRAFFIC_SPIKE') THEN 'CRITICAL' ELSE 'WARNING' END AS severity "
    "FROM typed")))
def q_classify_alerts(spark, sf_dir):
    """Anomalies joined to baselines and classified."""
    c = TB.clean(spark, sf_dir)
    scored = TB.standin_scored(c).filter(F.col("anomaly_score") >= 0.85)
    cls = A.classify(A.with_baseline(scored, A.baselines(c)))
    return cls.select("event_id", "kafka_offset", "camera_id", "anomaly_score", "pct_above_baseline",
                      "alert_type", "severity")


@register("alert_messages", O.with_adapter(*ALERTS_SQL[:7], body="SELECT * FROM recs"))
def q_alert_messages(spark, sf_dir):
    """U4: alert records with message text (one per anomalous delivery)."""
    return TB.standin_alerts(spark, sf_dir)


@register("acknowledged_alerts", O.with_adapter(*ALERTS_SQL, body="SELECT * FROM alerts_tbl"))
def q_acknowledged_alerts(spark, sf_dir):
    """The alerts table with acknowledgement state."""
    return TB.alerts_table(spark, sf_dir)


@register("unknown_acks", O.with_adapter(*ALERTS_SQL, body=(
    "SELECT alert_id || '_x' AS alert_id, created_at + INTERVAL 2 HOUR AS acked_at FROM alerts_tbl "
    "WHERE cast(event_id as bigint) % 7 = 0")))
def q_unknown_acks(spark, sf_dir):
    """Acknowledgements that name no stored alert."""
    alerts = TB.alerts_table(spark, sf_dir)
    wrong = alerts.filter(F.col("event_id").cast("long") % 7 == 0).select(
        F.concat("alert_id", F.lit("_x")).alias("alert_id"),
        (F.col("created_at") + F.expr("INTERVAL 2 HOURS")).alias("acked_at"))
    return A.unknown_acks(alerts, TB.standin_acks(alerts).unionByName(wrong))


@register("recent_alerts", O.with_adapter(*ALERTS_SQL, body=(
    "SELECT * FROM alerts_tbl ORDER BY created_at DESC, alert_id LIMIT 50")))
def q_recent_alerts(spark, sf_dir):
    """50 newest alerts."""
    return S.recent_alerts(TB.alerts_table(spark, sf_dir), limit=50)


@register("active_anomalies", O.with_adapter(NOW_CTE, *ALERTS_SQL, body=(
    "SELECT w.window_minutes, a.severity, a.alert_type, count(*) AS alerts, "
    "cast(count_if(a.acknowledged_at IS NULL OR a.acknowledged_at > nowt.now) as bigint) AS unacknowledged "
    "FROM alerts_tbl a, nowt, (SELECT unnest([15, 60, 1440]) AS window_minutes) w "
    "WHERE a.created_at >= nowt.now - to_minutes(w.window_minutes) AND a.created_at <= nowt.now "
    "GROUP BY 1, 2, 3")))
def q_active_anomalies(spark, sf_dir):
    """Alerts in the last 15 / 60 / 1440 minutes by severity and type."""
    c, now = TB.clean_and_now(spark, sf_dir)
    return S.active_anomalies(TB.alerts_table(spark, sf_dir), as_of=now, windows=(15, 60, 1440))


@register("new_alerts_only", O.with_adapter(NOW_CTE, *ALERTS_SQL[:7], body=(
    "SELECT DISTINCT * FROM recs WHERE alert_id NOT IN (SELECT alert_id FROM recs, nowt "
    "WHERE created_at < nowt.now - INTERVAL 7 DAY)")))
def q_new_alerts_only(spark, sf_dir):
    """A re-run's alerts minus those a run a week earlier stored."""
    c, now = TB.clean_and_now(spark, sf_dir)
    run = TB.standin_alerts(spark, sf_dir)
    existing = A.append_new_alerts(
        run.filter(F.col("created_at") < X.ts_value(now) - F.expr("INTERVAL 7 DAYS")), None)
    return A.append_new_alerts(run, existing, time_bounded=True)


@register("unnamed_event_alerts", O.with_adapter(*ALERTS_SQL[:6], body=(
    "SELECT DISTINCT camera_id || '_' || cast(cast(floor(epoch(event_ts)) as bigint) as varchar) || '_' || alert_type "
    f"|| '_' || CASE WHEN cast(event_id as bigint) % 3 = 0 THEN {UNNAMED_KEY} ELSE event_id END AS alert_id, "
    "camera_id, alert_type, event_ts AS created_at, "
    "CASE WHEN cast(event_id as bigint) % 3 <> 0 THEN event_id END AS event_id FROM typed")))
def q_unnamed_event_alerts(spark, sf_dir):
    """U4/K4: alerts of a batch in which every third event has no id; what a run with
    other scores (so other batch-dependent columns) stored before is not stored again."""
    c = TB.clean(spark, sf_dir)
    unnamed = F.when(F.col("event_id").cast("long") % 3 != 0, F.col("event_id"))
    scored = TB.standin_scored(c).filter("anomaly_score >= 0.85").withColumn("event_id", unnamed)
    base = A.baselines(c)
    early = A.build_alerts(scored.withColumn("anomaly_score", F.lit(0.99)).filter("event_hour < 12"), base)
    stored = A.append_new_alerts(early, None)
    columns = ["alert_id", "camera_id", "alert_type", "created_at", "event_id"]
    return stored.unionByName(A.append_new_alerts(A.build_alerts(scored, base), stored)).select(*columns)


@register("alert_topic_rows", O.with_adapter(*ALERTS_SQL[:7], body=(
    "SELECT t.topic, r.camera_id AS key, r.alert_id, to_json(struct_pack(alert_id := r.alert_id, "
    "camera_id := r.camera_id, alert_type := r.alert_type, severity := r.severity, "
    "anomaly_score := r.anomaly_score, message := r.message, "
    "created_at := strftime(r.created_at, '%Y-%m-%dT%H:%M:%S.%fZ'), "
    "baseline_vehicle_count := r.baseline_vehicle_count, current_vehicle_count := r.current_vehicle_count, "
    "pct_above_baseline := r.pct_above_baseline))::varchar AS value "
    "FROM (SELECT DISTINCT * FROM recs) r, (SELECT unnest(['traffic.anomalies', 'traffic.alerts']) AS topic) t")))
def q_alert_topic_rows(spark, sf_dir):
    """K5: Kafka records (two topics, keyed by camera) of the new alerts."""
    return A.alerts_to_kafka(A.append_new_alerts(TB.standin_alerts(spark, sf_dir), None))


@register("registry_upsert", O.with_adapter(
    "obs AS (SELECT camera_id, min(location) AS location, min(latitude) AS latitude, "
    "min(longitude) AS longitude FROM clean GROUP BY camera_id)",
    body=("SELECT camera_id, location, latitude, longitude, zone, true AS active FROM registry "
          "UNION ALL SELECT camera_id, location, latitude, longitude, NULL AS zone, true AS active FROM obs "
          "WHERE camera_id NOT IN (SELECT camera_id FROM registry)")))
def q_registry_upsert(spark, sf_dir):
    """Registry with insert-if-absent of newly observed cameras."""
    c = TB.clean(spark, sf_dir)
    seen = c.select("camera_id", "location", "latitude", "longitude",
                    F.lit(None).cast("string").alias("zone"), F.lit(True).alias("active"))
    return upsert_registry(TB.registry(spark), seen)


# ============================================================================
# Isolation forest (rows-only checks; scaler statistics are SQL-checked)
# ============================================================================

def _scaler_sql(adapter: str = ADAPTER_SQL) -> str:
    from ..schema import FEATURE_COLS, INTEGRAL_FEATURES
    parts = []
    for f in FEATURE_COLS:
        integral = f in INTEGRAL_FEATURES
        m = O.imean(f) if integral else O.mean(f)
        sd = O.pop_std(f, integral)
        parts.append(f"SELECT '{f}' AS feature, count({f}) AS n, {m} AS mean, "
                     f"CASE WHEN {sd} > 0 THEN {sd} ELSE cast(1.0 as double) END AS std FROM feat")
    return O.with_adapter(ALERTS_SQL[0], body=" UNION ALL ".join(parts), adapter=adapter)


@register("scaler_stats", _scaler_sql())
def q_scaler_stats(spark, sf_dir):
    """Feature means and population stds (zero std -> 1)."""
    from ..operators.iforest import fit_scaler
    from ..schema import FEATURE_COLS
    return fit_scaler(TB.clean(spark, sf_dir).dropna(subset=FEATURE_COLS))


@register("scaler_stats_rough", _scaler_sql(ROUGH_SQL))
def q_scaler_stats_rough(spark, sf_dir):
    """A7 over values of seven decimals."""
    from ..operators.iforest import fit_scaler
    from ..schema import FEATURE_COLS
    return fit_scaler(TB.rough_clean(spark, sf_dir).dropna(subset=FEATURE_COLS))


SCAN_COLS = ["event_id", "kafka_offset", "camera_id", "event_ts", "vehicle_count", "average_speed"]


@register("clean_window_scan", O.with_adapter(NOW_CTE, body=(
    f"SELECT {', '.join('c.' + x for x in SCAN_COLS)} FROM clean c, nowt "
    "WHERE c.event_ts >= nowt.now - INTERVAL 48 HOUR AND c.event_ts < nowt.now")))
def q_clean_window_scan(spark, sf_dir):
    """The 48 hours before the newest event (exclusive) of the clean rows."""
    from .detect import recent_window
    c, now = TB.clean_and_now(spark, sf_dir)
    return recent_window(c, as_of=now, window_hours=48).select(*SCAN_COLS)


@register("clean_day_scan", O.with_adapter(NOW_CTE, body=(
    f"SELECT {', '.join('c.' + x for x in SCAN_COLS)} FROM clean c, nowt "
    "WHERE c.event_date = cast(nowt.now as date)")))
def q_clean_day_scan(spark, sf_dir):
    """The clean rows of the newest event's day."""
    from .detect import clean_day
    c, now = TB.clean_and_now(spark, sf_dir)
    return clean_day(c, now.date()).select(*SCAN_COLS)


@register("forest_min_max", O.with_adapter(ALERTS_SQL[0], body=(
    "SELECT event_id, kafka_offset, camera_id, anomaly_raw, "
    "1.0::double - (anomaly_raw - lo) / (hi - lo + 1e-9::double) AS anomaly_score FROM ("
    "SELECT *, min(anomaly_raw) OVER () AS lo, max(anomaly_raw) OVER () AS hi FROM ("
    "SELECT event_id, kafka_offset, camera_id, "
    "-cast((cast(event_id as bigint) * 7919) % 1000 as double) / 1000 AS anomaly_raw FROM feat)) "
    "WHERE 1.0::double - (anomaly_raw - lo) / (hi - lo + 1e-9::double) >= 0.85")))
def q_forest_min_max(spark, sf_dir):
    """Stand-in raw scores scaled by the batch's min and max, at the threshold or over."""
    from ..operators.iforest import min_max_score
    raw = TB.standin_scored(TB.clean(spark, sf_dir)).select(
        "event_id", "kafka_offset", "camera_id", (-F.col("anomaly_score")).alias("anomaly_raw"))
    lo, hi = raw.agg(F.min("anomaly_raw"), F.max("anomaly_raw")).first()
    return raw.withColumn("anomaly_score", min_max_score(F.lit(lo), F.lit(hi))) \
        .filter(F.col("anomaly_score") >= 0.85)


@register("forest_scores", None)
def q_forest_scores(spark, sf_dir):
    """Isolation-forest scores of every clean row (batch min-max)."""
    from ..operators.iforest import fit_forest, score_events
    c = TB.clean(spark, sf_dir)
    model = fit_forest(c)
    return score_events(c, model).select("event_id", "kafka_offset", "camera_id", "anomaly_raw", "anomaly_score")


# Stand-in forest, by rule (fixed values): complete trees of depth 4; the split of node n of tree t.
STANDIN_TREES, STANDIN_DEPTH = 8, 4
STANDIN_RANGE = {"vehicle_count": 500, "average_speed": 120, "congestion_score": 100, "pedestrian_count": 50,
                 "heavy_vehicle_pct": 100, "event_hour": 24}


def standin_forest():
    """A stored model whose node table SQL can make as well."""
    import pandas as pd

    from ..operators.iforest import ForestModel
    from ..schema import FEATURE_COLS
    inner = (1 << STANDIN_DEPTH) - 1
    rows = []
    for t in range(STANDIN_TREES):
        for n in range(2 * inner + 1):
            f = (3 * t + n) % len(FEATURE_COLS) if n < inner else -1
            threshold = float((37 * t + 53 * n) % STANDIN_RANGE[FEATURE_COLS[f]]) if f >= 0 else 0.0
            rows.append((t, n, f, threshold, 2 * n + 1 if f >= 0 else -1, 2 * n + 2 if f >= 0 else -1,
                         0.0 if f >= 0 else STANDIN_DEPTH + (5 * t + n) % 7 / 4, 1))
    nodes = pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "path", "size"])
    return ForestModel(nodes=nodes, features=list(FEATURE_COLS), scaler={f: (0.0, 1.0) for f in FEATURE_COLS},
                       psi=1 << STANDIN_DEPTH, n_trees=STANDIN_TREES)


def _traversal_sql() -> str:
    from ..operators.iforest import c_factor
    from ..schema import FEATURE_COLS
    inner = (1 << STANDIN_DEPTH) - 1
    value = " ".join(f"WHEN {i} THEN cast(e.{f} as double)" for i, f in enumerate(FEATURE_COLS))
    limit = " ".join(f"WHEN {i} THEN {STANDIN_RANGE[f]}" for i, f in enumerate(FEATURE_COLS))
    return O.with_adapter(
        ALERTS_SQL[0],
        f"split AS (SELECT t, n, (3 * t + n) % {len(FEATURE_COLS)} AS f FROM range({STANDIN_TREES}) a(t), "
        f"range({inner}) b(n))",
        f"nodes AS (SELECT t, n, f, cast((37 * t + 53 * n) % CASE f {limit} END as double) AS threshold FROM split)",
        "e AS (SELECT row_number() OVER () AS rid, * FROM feat)",
        f"walk AS (SELECT rid, t, cast(0 as bigint) AS n, 0 AS depth FROM e, range({STANDIN_TREES}) a(t) "
        "UNION ALL SELECT w.rid, w.t, 2 * w.n + CASE WHEN (CASE s.f " + value + " END) <= s.threshold THEN 1 ELSE 2 END, "
        f"w.depth + 1 FROM walk w JOIN nodes s ON s.t = w.t AND s.n = w.n JOIN e ON e.rid = w.rid "
        f"WHERE w.depth < {STANDIN_DEPTH})",
        f"h AS (SELECT rid, sum({STANDIN_DEPTH} + cast((5 * t + n) % 7 as double) / 4) / {STANDIN_TREES} AS eh FROM walk "
        f"WHERE depth = {STANDIN_DEPTH} GROUP BY rid)",
        body=("SELECT e.event_id, e.kafka_offset, e.camera_id, "
              + O.rnd(f"-pow(cast(2.0 as double), -h.eh / cast({float(c_factor(1 << STANDIN_DEPTH))!r} as double))", 10)
              + " AS anomaly_raw FROM e JOIN h ON e.rid = h.rid")).replace("WITH ", "WITH RECURSIVE ", 1)


@register("forest_traversal", _traversal_sql())
def q_forest_traversal(spark, sf_dir):
    """Scores of every clean row by a stored model, saved and loaded again;
    the SQL twin walks the same node table by a recursive query."""
    import uuid

    from ..operators.iforest import ForestModel, score_raw
    from ..operators.joins import spread
    from ..schema import FEATURE_COLS
    from ..session import scratch_path
    path = scratch_path(spark, f"forest-{uuid.uuid4().hex}")
    standin_forest().save(spark, path)
    scored = score_raw(spread(TB.clean(spark, sf_dir).dropna(subset=FEATURE_COLS).select(
        "event_id", "kafka_offset", "camera_id", *FEATURE_COLS)), ForestModel.load(spark, path))
    return scored.select("event_id", "kafka_offset", "camera_id", F.round("anomaly_raw", 10).alias("anomaly_raw"))


@register("newest_stored_alerts", O.with_adapter(*ALERTS_SQL[:7], body=(
    "SELECT * FROM (SELECT DISTINCT * FROM recs) WHERE severity = 'WARNING' "
    "ORDER BY created_at DESC, alert_id LIMIT 120")))
def q_newest_stored_alerts(spark, sf_dir):
    """120 newest warnings of the stored alerts table, its days read newest first."""
    import uuid

    from ..session import scratch_path
    path = scratch_path(spark, f"alerts-{uuid.uuid4().hex}")
    A.append_alerts_table(spark, TB.standin_alerts(spark, sf_dir), path)
    return A.newest_stored_alerts(spark, path, severity="warning", limit=120)


@register("detect_alerts", None)
def q_detect_alerts(spark, sf_dir):
    """The full detection run over the clean zone (dry run, no writes)."""
    from .detect import detect
    return detect(spark, TB.clean(spark, sf_dir), window_hours=None, dry_run=True)


# ============================================================================
# Dimension lookup, filtered alerts, table maintenance (write, then read back)
# ============================================================================

@register("events_with_zone", O.with_adapter(body=(
    "SELECT c.event_id, c.kafka_offset, c.camera_id, r.zone, CASE WHEN r.camera_id IS NULL THEN NULL "
    "ELSE true END AS active FROM clean c LEFT JOIN registry r ON c.camera_id = r.camera_id")))
def q_events_with_zone(spark, sf_dir):
    """Every clean event with its registry zone (null outside the registry)."""
    from ..operators.enrich import with_zone
    return with_zone(TB.clean(spark, sf_dir), TB.registry(spark)).select(
        "event_id", "kafka_offset", "camera_id", "zone", "active")


@register("critical_alerts", O.with_adapter(*ALERTS_SQL, body=(
    "SELECT * FROM alerts_tbl WHERE severity = 'CRITICAL' ORDER BY created_at DESC, alert_id LIMIT 500")))
def q_critical_alerts(spark, sf_dir):
    """Newest CRITICAL alerts (severity filter upper-cased), limit 500."""
    return S.recent_alerts(TB.alerts_table(spark, sf_dir), severity="critical", limit=500)


@register("compacted_clean_zone", O.with_adapter(body=(
    f"SELECT {RAW_COLS}, {O.speed_index()} AS speed_index, congestion_category, is_peak_hour, "
    "event_date, event_hour FROM clean")))
def q_compacted_clean_zone(spark, sf_dir):
    """K8: the clean zone written as small files, packed into a new generation
    and read back with what was left in place: the row multiset is unchanged."""
    import uuid
    from ..session import scratch_path
    from .maintenance import compact_zone, read_compacted
    base = scratch_path(spark, f"compact-{uuid.uuid4().hex}")
    clean = TB.clean(spark, sf_dir).select(*CLEAN_OUT)
    clean.repartition(16).write.partitionBy("event_date").parquet(f"{base}/gen=0")
    gen1 = compact_zone(spark, f"{base}/gen=0", f"{base}/gen=1")
    return read_compacted(spark, f"{base}/gen=0", gen1).select(*CLEAN_OUT)


@register("daily_summary_table", O.with_adapter(*DAILY_CTES, body="SELECT * FROM daily"))
def q_daily_summary_table(spark, sf_dir):
    """K6: the daily summary table after writing every day twice with
    replace-day semantics (the re-run leaves the table unchanged)."""
    import uuid
    from ..schema import DAILY_FIELDS
    from ..session import scratch_path
    path = scratch_path(spark, f"daily-{uuid.uuid4().hex}")
    summary = D.daily_summary(TB.clean(spark, sf_dir))
    D.replace_day(summary, path)
    D.replace_day(summary, path)
    return spark.read.parquet(path).select(*DAILY_FIELDS)
