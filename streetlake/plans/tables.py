"""Input tables of a scale-factor folder and the frames derived from them.

``raw`` is what the raw zone holds (decoded events with broker columns) and
``clean`` what the clean zone holds; both are derived from the driver's
``events`` table by the fixture adapter, so every query's work grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.registry import camera_registry
from ..operators.enrich import enrich
from ..operators.quality import validate
from ..sources.decode import decode_events
from ..sources.fixtures import to_wire, traffic_raw, traffic_rough


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic_raw(table(spark, sf_dir, "events"))


def rough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw`` with ids and offsets missing, finer decimals and late second deliveries."""
    return traffic_rough(raw(spark, sf_dir))


def rough_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(validate(rough(spark, sf_dir)), processing_time=False)


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped records (JSON value) as a producer would send them.

    JSON rendering and parsing are the CPU-heavy per-row work here, so an
    input that arrives as fewer partitions than cores (one small file) is
    spread first; a large, well-partitioned input is left as is.
    """
    from ..operators.joins import spread
    return to_wire(traffic_raw(spread(table(spark, sf_dir, "events"))))


def decoded(spark: SparkSession, sf_dir: str, keep_value: bool = False) -> DataFrame:
    return decode_events(wire(spark, sf_dir), keep_value=keep_value)


def clean(spark: SparkSession, sf_dir: str, processing_time: bool = False) -> DataFrame:
    return enrich(validate(raw(spark, sf_dir)), processing_time=processing_time)


def registry(spark: SparkSession) -> DataFrame:
    return camera_registry(spark)


def clean_and_now(spark: SparkSession, sf_dir: str):
    """The clean frame and its 'now' (newest event time) as a literal."""
    c = clean(spark, sf_dir)
    return c, as_of(c)


def as_of(clean_df: DataFrame):
    """The fixture's 'now': the newest event time.

    Resolved once to a literal (one aggregate job returning one value), so the
    time filters that use it are plain literal predicates: pushed to Parquet
    and pruning ``event_date`` partitions on a stored clean zone.
    """
    return clean_df.agg(F.max("event_ts")).first()[0]


# --- fixture stand-ins for the alert side (SQL-checkable; FIXTURES.md §3) ------
# fixed values: score = ((event_id * 7919) % 1000) / 1000; alerts of events with
# event_id % 5 = 0 are acknowledged one hour after creation.
STANDIN_MULT = 7919
STANDIN_ACK_EVERY = 5


def standin_scored(clean_df: DataFrame) -> DataFrame:
    from ..schema import FEATURE_COLS
    eid = F.col("event_id").cast("long")
    return (clean_df.dropna(subset=FEATURE_COLS)
            .withColumn("anomaly_score", ((eid * STANDIN_MULT) % 1000).cast("double") / 1000))


def standin_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert records (one per anomalous delivered row) from the stand-in score."""
    from ..operators.alerts import baselines, build_alerts
    c = clean(spark, sf_dir)
    return build_alerts(standin_scored(c), baselines(c))


def standin_acks(alerts: DataFrame) -> DataFrame:
    return (alerts.filter(F.col("event_id").cast("long") % STANDIN_ACK_EVERY == 0)
            .select("alert_id", (F.col("created_at") + F.expr("INTERVAL 1 HOUR")).alias("acked_at")))


def alerts_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts table: insert-if-absent of the stand-in alerts, with acks."""
    from ..operators.alerts import alerts_with_ack, append_new_alerts
    from ..session import cut_lineage
    # written once (checkpoint) and read by both sides of the ack join
    a = cut_lineage(append_new_alerts(standin_alerts(spark, sf_dir), None))
    return alerts_with_ack(a, standin_acks(a))
