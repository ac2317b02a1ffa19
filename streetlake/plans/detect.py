"""Anomaly detection run (U5) and the clean-zone scans it uses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import alerts as A
from ..operators.iforest import ForestModel, calibrate_model, fit_forest, score_events
from ..schema import FEATURE_COLS


DETECT_COLS = ["event_id", "kafka_offset", "camera_id", "event_ts", "accident_detected"] + FEATURE_COLS


def recent_window(clean: DataFrame, as_of=None, window_hours: float | None = 48) -> DataFrame:
    """Rows of the last ``window_hours`` before as_of (up to now without it).

    The implied ``event_date >=`` predicate lets a partitioned clean zone prune
    whole day directories; the ``event_ts`` predicate is pushed to Parquet.
    """
    if window_hours is None:
        return clean
    now = X.ts_value(as_of)
    cutoff = now - F.expr(f"INTERVAL {int(window_hours * 3600)} SECONDS")
    out = clean.filter(F.col("event_ts") >= cutoff)
    if as_of is not None:
        out = out.filter(F.col("event_ts") < now)       # a past run doesn't see later events
    if "event_date" in clean.columns:
        # lower bound: prune older days/hours
        d = F.col("event_date")
        pred = d >= F.to_date(cutoff)
        if "event_hour" in clean.columns:
            pred = pred & ((d > F.to_date(cutoff)) | (F.col("event_hour") >= F.hour(cutoff)))
        out = out.filter(pred)
    return out


def clean_day(clean: DataFrame, date) -> DataFrame:
    """One day of the clean zone (partition filter)."""
    return clean.filter(F.col("event_date") == F.lit(str(date)).cast("date"))


def read_clean(spark: SparkSession, path: str, as_of=None, window_hours: float | None = 48,
               columns=None, fmt: str | None = None) -> DataFrame:
    """The clean zone's last ``window_hours`` before as_of, projected.

    Reads through ``read_zone`` (partition discovery, table/commit log); the
    filters prune day partitions and push down to Parquet, the projection
    prunes columns.
    """
    from ..sources.streams import read_zone
    df = recent_window(read_zone(spark, path, fmt), as_of, window_hours)
    return df.select(*columns) if columns else df


def read_clean_day(spark: SparkSession, path: str, date, fmt: str | None = None,
                   require_rows: bool = True) -> DataFrame:
    """One day of the clean zone; an empty day is an error by default
    (the pipeline may be down)."""
    from ..sources.streams import read_zone
    day = clean_day(read_zone(spark, path, fmt), date)
    if require_rows and day.isEmpty():
        raise ValueError(f"No data found for {date} - pipeline may be down.")
    return day


def detect(spark: SparkSession, clean: DataFrame, model_path: str | None = None,
           window_hours: float | None = 48, threshold: float = 0.85, retrain: bool = False,
           dry_run: bool = False, as_of=None, norm: str = "batch",
           alerts_path: str | None = None, publish_servers: str | None = None,
           spike_pct: float = A.SPIKE_PCT, min_speed: float = A.MIN_SPEED_ALERT) -> DataFrame | None:
    """Scan -> (load | fit) model -> score -> classify -> (append alerts).

    Returns the alert records, or None when the window holds no rows.  With
    ``dry_run`` nothing is written (neither the model nor alerts); with
    ``publish_servers`` new alerts also go to the two Kafka alert topics.
    """
    # only what fitting, scoring and alert records need: the Parquet scan
    # prunes the rest, and the stored scores stay narrow
    scan = (recent_window(clean, as_of, window_hours).dropna(subset=FEATURE_COLS)
            .select(*[c for c in DETECT_COLS if c in clean.columns]))
    model = None if retrain else ForestModel.load(spark, model_path)
    fitted = model is None
    if fitted:
        model = fit_forest(scan, calibrate=(norm == "model"))
        if model is None:                   # no rows in the window
            return None
    scored = score_events(scan, model, norm=norm)     # stored when norm="batch"
    if fitted and model_path and not dry_run:
        if model.score_min is None:
            # the scored rows are the training rows: streams can then score
            # with norm="model"
            calibrate_model(model, scored)
        model.save(spark, model_path)
    if norm != "model" and scored.isEmpty():
        return None                         # loaded model, empty window (reads the stored scores)
    # baselines from the scored rows (feature-complete by construction): with
    # batch normalisation these are read from the stored scores, not re-scanned
    alerts = A.build_alerts(scored, A.baselines(scored), threshold=threshold,
                            spike_pct=spike_pct, min_speed=min_speed)
    if alerts_path and not dry_run:
        A.append_alerts_table(spark, alerts, alerts_path, publish_servers=publish_servers)
    return alerts
