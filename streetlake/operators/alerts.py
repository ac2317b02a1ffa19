"""Baselines, alert classification and records, and the alerts table
(A6, P9, J1, U3, U4, K4, K5, K10).

Classification is a ``when`` chain and the message text is built with
``format_string``/``concat``: no per-row Python.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..schema import ALERT_FIELDS, FEATURE_COLS
from .joins import attach_small

SPIKE_PCT = 200.0
MIN_SPEED_ALERT = 10.0
DEFAULT_BASELINE = 100.0
ALERT_TOPICS = ("traffic.anomalies", "traffic.alerts")

# --- fixed values: alert message templates (Python str.format fields) ---------
#   ACCIDENT       "Accident pattern detected on {cam}. Speed dropped to {spd} km/h with accident_detected=True."
#   TRAFFIC_SPIKE  "Anomaly detected: {cam} has {pct_above}% higher vehicle count than normal ({vc} vs baseline {base:.0f})."
#   LOW_SPEED      "{cam} reporting critically low speed: {spd} km/h. Possible blockage."
#   UNUSUAL_COUNT  "Unusual vehicle count on {cam}: {vc} (anomaly score {score:.3f})."


def baselines(df: DataFrame) -> DataFrame:
    """Per-camera mean vehicle count over feature-complete rows."""
    return (df.dropna(subset=FEATURE_COLS).groupBy("camera_id")
            .agg(X.mean_of("vehicle_count", integral=True).alias("baseline_vehicle_count")))


def baseline_sums(df: DataFrame) -> DataFrame:
    """The mergeable state behind ``baselines``: rows and vehicles per camera."""
    return (df.dropna(subset=FEATURE_COLS).groupBy("camera_id")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("vehicle_count").cast("long")).alias("vehicles")))


def merge_baseline_sums(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sum of two states; a camera may be in either or both."""
    return a.unionByName(b).groupBy("camera_id").agg(F.sum("n").alias("n"), F.sum("vehicles").alias("vehicles"))


def baselines_from_sums(sums: DataFrame) -> DataFrame:
    """``baselines`` from the state: the same exact sum over the same count."""
    return sums.select("camera_id", F.try_divide(F.col("vehicles").cast("double"), F.col("n"))
                       .alias("baseline_vehicle_count"))


def with_baseline(df: DataFrame, base: DataFrame, checked: bool = False) -> DataFrame:
    """Left join of the per-camera baseline (size-checked broadcast).

    ``checked=True`` when ``base`` already passed ``attach_small``'s check
    (e.g. once before a stream starts), so it is broadcast without another.
    """
    if checked:
        return df.join(F.broadcast(base), "camera_id", "left")
    return attach_small(df, base, "camera_id", "left")


def classify(df: DataFrame, spike_pct: float = SPIKE_PCT,
             min_speed: float = MIN_SPEED_ALERT) -> DataFrame:
    """Alert type and severity, first matching rule wins."""
    base = F.coalesce(F.col("baseline_vehicle_count"), F.lit(DEFAULT_BASELINE))
    out = df.withColumn("_base", base).withColumn(
        "pct_above_baseline", X.pct_above("vehicle_count", "_base"))
    spd, pct = F.col("average_speed"), F.col("pct_above_baseline")
    accident = F.coalesce(F.col("accident_detected"), F.lit(False))
    rule = (F.when((spd < min_speed) & accident, F.struct(F.lit("ACCIDENT").alias("t"), F.lit("CRITICAL").alias("s")))
            .when(pct >= spike_pct, F.struct(F.lit("TRAFFIC_SPIKE").alias("t"), F.lit("CRITICAL").alias("s")))
            .when(spd < min_speed, F.struct(F.lit("LOW_SPEED").alias("t"), F.lit("WARNING").alias("s")))
            .otherwise(F.struct(F.lit("UNUSUAL_COUNT").alias("t"), F.lit("WARNING").alias("s"))))
    return (out.withColumn("_rule", rule)
            .withColumn("alert_type", F.col("_rule.t"))
            .withColumn("severity", F.col("_rule.s"))
            .drop("_rule"))


def _message() -> Column:
    cam, t = F.col("camera_id"), F.col("alert_type")
    spd = F.col("average_speed").cast("string")
    vc = F.col("vehicle_count").cast("string")
    pct = F.col("pct_above_baseline").cast("string")
    base0 = F.bround(F.col("_base"), 0).cast("long").cast("string")
    score3 = F.format_string("%.3f", F.col("anomaly_score"))
    return (F.when(t == "ACCIDENT", F.concat(
                F.lit("Accident pattern detected on "), cam, F.lit(". Speed dropped to "), spd,
                F.lit(" km/h with accident_detected=True.")))
            .when(t == "TRAFFIC_SPIKE", F.concat(
                F.lit("Anomaly detected: "), cam, F.lit(" has "), pct,
                F.lit("% higher vehicle count than normal ("), vc, F.lit(" vs baseline "), base0, F.lit(").")))
            .when(t == "LOW_SPEED", F.concat(
                cam, F.lit(" reporting critically low speed: "), spd, F.lit(" km/h. Possible blockage.")))
            .otherwise(F.concat(
                F.lit("Unusual vehicle count on "), cam, F.lit(": "), vc,
                F.lit(" (anomaly score "), score3, F.lit(")."))))


def reading_key() -> Column:
    """Name of an event without an id: the md5 of its own columns, none of which
    depends on the batch it is scored in."""
    own = [F.col("camera_id"), F.unix_micros("event_ts"), "vehicle_count", "average_speed", "congestion_score",
           "pedestrian_count", "heavy_vehicle_pct", F.coalesce(F.col("accident_detected"), F.lit(False))]
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in own]
    return F.concat(F.lit("x"), F.md5(F.concat_ws("|", *texts).cast("binary")))


def alert_records(classified: DataFrame) -> DataFrame:
    """U4: the alert record.  ``alert_id`` is deterministic and re-run safe:
    camera _ epoch(event_ts) _ type _ event_id; ``created_at`` = event time.
    An event without an id is named by ``reading_key``."""
    eid = F.coalesce(F.col("event_id"), reading_key())
    aid = F.concat_ws("_", F.col("camera_id"), F.unix_seconds("event_ts").cast("string"),
                      F.col("alert_type"), eid)
    return classified.select(
        aid.alias("alert_id"), "camera_id", "alert_type", "severity",
        F.round("anomaly_score", 4).alias("anomaly_score"),
        _message().alias("message"),
        F.col("event_ts").alias("created_at"),
        F.round("_base", 2).alias("baseline_vehicle_count"),
        F.col("vehicle_count").alias("current_vehicle_count"),
        "pct_above_baseline", "event_id")


def build_alerts(scored: DataFrame, base: DataFrame, threshold: float = 0.85,
                 base_checked: bool = False, **kw) -> DataFrame:
    """Anomalies (score >= threshold) -> baseline -> classification -> records."""
    anomalies = scored.filter(F.col("anomaly_score") >= threshold)
    return alert_records(classify(with_baseline(anomalies, base, base_checked), **kw))


def append_new_alerts(alerts: DataFrame, existing: DataFrame | None,
                      time_bounded: bool = False) -> DataFrame:
    """Insert-if-absent by alert_id (batch de-duplicated first).

    Rows sharing an alert_id come from re-deliveries of one event and are
    identical, so keeping any one of them is deterministic.

    ``time_bounded``: an alert id embeds its event time (= created_at), so
    only existing alerts inside the new batch's created_at range can collide;
    the existing table is read for that range only (partition-pruned on
    ``created_date`` when the table is laid out by ``write_alerts``), instead
    of anti-joining against the whole, ever-growing table.
    """
    fresh = alerts.dropDuplicates(["alert_id"])
    if existing is None:
        return fresh
    if time_bounded:
        lo, hi = fresh.agg(F.min("created_at"), F.max("created_at")).first()
        if lo is None:
            return fresh
        existing = existing.filter(F.col("created_at").between(F.lit(lo), F.lit(hi)))
        if "created_date" in existing.columns:
            existing = existing.filter(F.col("created_date").between(F.lit(lo).cast("date"),
                                                                     F.lit(hi).cast("date")))
    return fresh.join(existing.select("alert_id"), "alert_id", "left_anti")


def write_alerts(alerts: DataFrame, path: str) -> None:
    """K4: append alerts to the alerts table, laid out by ``created_date``."""
    (alerts.withColumn("created_date", F.to_date("created_at"))
     .write.mode("append").partitionBy("created_date").parquet(path))


def alert_days(spark, path: str) -> list:
    """Days (``created_date``) of the alerts table, newest first, from its file listing."""
    from ..plans.maintenance import list_files
    files = list_files(spark, path)
    if files is None or "created_date" not in files.columns:
        return []
    days = [r[0] for r in files.select("created_date").distinct().collect()]      # one row per day
    return sorted((d for d in days if d is not None), reverse=True) + [None] * (None in days)


def newest_stored_alerts(spark, path: str, severity: str | None = None, limit: int = 50) -> DataFrame:
    """V3/W2 over the stored table: its days are walked newest first, twice as
    many at each step, until they hold ``limit`` matching alerts; only those
    days are read.  Alerts without a time come last, as in the full sort."""
    from .serving import recent_alerts
    days, at, step, found = alert_days(spark, path), 0, 1, 0
    table = spark.read.parquet(path)
    if "created_date" not in table.columns:             # not laid out by day
        return recent_alerts(table, severity, limit)
    match = F.lit(True) if severity is None else F.col("severity") == severity.upper()

    def within(some):
        known = F.col("created_date").isin([d for d in some if d is not None])
        return known | F.col("created_date").isNull() if None in some else known

    while at < len(days) and found < limit:
        found += table.filter(within(days[at:at + step])).filter(match).limit(limit - found).count()
        at, step = at + step, step * 2
    return recent_alerts(table.filter(within(days[:at])), severity, limit).drop("created_date")


OUTBOX = "outbox"


def append_alerts_table(spark, alerts: DataFrame, path: str,
                        publish_servers: str | None = None, topics=ALERT_TOPICS, send=None) -> DataFrame:
    """K4 (+K5): insert-if-absent into the alerts table at ``path`` (re-run
    safe) and, with ``publish_servers`` (or a ``send`` function), send the same
    new alerts to the topics.  Returns the new alerts.

    The table is its own outbox: a batch of new alerts is stored first, under
    ``batch_id`` in the outbox beside the table; what is sent is what the outbox
    holds, and a batch is marked sent after that.  A run that fails between the
    two leaves an unmarked batch, which the next run sends before its own: no
    alert is lost, and only a batch whose mark was not written is sent twice,
    with the same ids.
    """
    import uuid

    from ..session import cut_lineage
    wants_sending = publish_servers is not None or send is not None
    send = send or (lambda frame: write_kafka(frame, publish_servers))
    if wants_sending:
        publish_outbox(spark, path, send, topics)
    try:
        existing = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        existing = None                   # first run: no table yet
    fresh = cut_lineage(append_new_alerts(cut_lineage(alerts), existing, time_bounded=True))
    if wants_sending:
        # recorded before the table is written: a batch the table lacks is stored by the resend
        fresh.withColumn("batch_id", F.lit(uuid.uuid4().hex)).write.mode("append") \
            .partitionBy("batch_id").parquet(_outbox(path))
    write_alerts(fresh, path)
    if wants_sending:
        publish_outbox(spark, path, send, topics)
    return fresh


def _outbox(path: str) -> str:
    return f"{path.rstrip('/')}_{OUTBOX}"


def pending_batches(spark, path: str) -> list[str]:
    """Batches of the outbox that are not marked as sent."""
    from ..plans.maintenance import list_files
    files = list_files(spark, _outbox(path))
    if files is None or "batch_id" not in files.columns:
        return []
    batches = {r[0] for r in files.select(F.col("batch_id").cast("string")).distinct().collect()}   # one per run
    try:
        sent = {r[0] for r in spark.read.parquet(_outbox(path) + "_sent").select("batch_id").collect()}
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        sent = set()
    return sorted(batches - sent)


def publish_outbox(spark, path: str, send, topics=ALERT_TOPICS) -> int:
    """Send every unmarked batch of the outbox and mark it; returns how many were sent.

    Alerts of a batch that the table lacks (a run that stopped before its
    table was written) are stored first, by the same insert-if-absent.
    """
    pending = pending_batches(spark, path)
    schema = spark.read.parquet(_outbox(path)).drop("batch_id").schema if pending else None
    for batch in pending:
        rows = spark.read.schema(schema).parquet(f"{_outbox(path)}/batch_id={batch}")
        try:
            existing = spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            existing = None
        lacking = append_new_alerts(rows, existing, time_bounded=True)
        if lacking.limit(1).count():
            from ..session import cut_lineage
            write_alerts(cut_lineage(lacking), path)
        send(alerts_to_kafka(rows, topics))
        spark.createDataFrame([(batch,)], "batch_id string").withColumn("sent_at", F.current_timestamp()) \
            .coalesce(1).write.mode("append").parquet(_outbox(path) + "_sent")
    return len(pending)


def alerts_with_ack(alerts: DataFrame, acks: DataFrame) -> DataFrame:
    """Alerts with ``acknowledged`` / ``acknowledged_at`` from an ack log
    (alert_id, acked_at); the earliest ack of an id wins."""
    first = acks.groupBy("alert_id").agg(F.min("acked_at").alias("acknowledged_at"))
    out = alerts.join(first, "alert_id", "left")
    return out.withColumn("acknowledged", F.col("acknowledged_at").isNotNull())


def unknown_acks(alerts: DataFrame, acks: DataFrame) -> DataFrame:
    """Acks naming no existing alert (the 404 case)."""
    return acks.join(alerts.select("alert_id"), "alert_id", "left_anti")


def acknowledge(acks: DataFrame, alert_ids, at) -> DataFrame:
    """Append acknowledgements to an ack log frame."""
    spark = acks.sparkSession
    rows = spark.createDataFrame([(a,) for a in alert_ids], "alert_id string")
    return acks.unionByName(rows.withColumn("acked_at", X.ts_value(at)))


def store_acks(spark, alerts_path: str, acks_path: str, alert_ids, at=None) -> list[str]:
    """Append acknowledgements of stored alerts to the ack log and return
    the ids that name no alert (the 404 case; nothing is stored for them).

    An id holds its alert's second, so only those days of the table are read.
    """
    asked = spark.createDataFrame([(a,) for a in sorted(set(alert_ids))], "alert_id string")
    second = F.regexp_extract("alert_id", r"_(\d+)_[A-Z_]+_", 1).try_cast("long")
    days = [r[0] for r in asked.select(F.to_date(F.timestamp_seconds(second))).distinct().collect() if r[0]]
    known = {r[0] for r in spark.read.parquet(alerts_path).filter(F.col("created_date").isin(days))
             .join(F.broadcast(asked), "alert_id", "left_semi").select("alert_id").collect()}    # <= the ids asked for
    found = asked.filter(F.col("alert_id").isin(sorted(known))).withColumn("acked_at", X.ts_value(at))
    if known:
        found.coalesce(1).write.mode("append").parquet(acks_path)
    return sorted(set(alert_ids) - known)


def alerts_to_kafka(alerts: DataFrame, topics=ALERT_TOPICS) -> DataFrame:
    """K5: one Kafka record per (alert, topic): key = camera_id, value = JSON."""
    fields = []
    for c in ALERT_FIELDS:
        v = (F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") if c == "created_at"
             else F.col(c))
        fields += [F.lit(c), v]
    return alerts.select(
        F.explode(F.array(*[F.lit(t) for t in topics])).alias("topic"),
        F.col("camera_id").alias("key"),
        F.col("alert_id"),
        F.to_json(F.named_struct(*fields)).alias("value"))


def write_kafka(frame: DataFrame, servers: str) -> None:
    """K5: publish a frame from ``alerts_to_kafka`` (needs the Kafka connector)."""
    (frame.select("topic", "key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).save())
