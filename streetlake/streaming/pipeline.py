"""The streaming pipeline (T1-T7, K1-K3): raw, clean and analytics zones.

Three independent queries share one source definition, each with its own
checkpoint and trigger; restarting from the checkpoints neither loses nor
duplicates rows (file/Delta sinks are idempotent per batch id).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import alerts as A
from ..operators.enrich import enrich
from ..operators.iforest import ForestModel, score_events, share_model
from ..operators.quality import dedup_stream, observe_rejects, split_quarantine, validate
from ..operators.windows import WATERMARK, sliding_metrics
from ..sources.decode import decode_events
from ..sources.streams import zone_format

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

RAW_TRIGGER = "5 seconds"
CLEAN_TRIGGER = "5 seconds"
ANALYTICS_TRIGGER = "30 seconds"


@dataclass
class ZonePaths:
    base: str

    @property
    def raw(self):
        return f"{self.base}/raw"

    @property
    def clean(self):
        return f"{self.base}/clean"

    @property
    def quarantine(self):
        return f"{self.base}/quarantine"

    @property
    def analytics(self):
        return f"{self.base}/analytics"

    def checkpoint(self, name):
        return f"{self.base}/_checkpoints/{name}"


def _trigger(w, trigger: str | None, available_now: bool):
    if available_now:
        return w.trigger(availableNow=True)
    return w.trigger(processingTime=trigger) if trigger else w


def write_zone(df: DataFrame, path: str, checkpoint: str, trigger: str | None = RAW_TRIGGER,
               partition_by=None, fmt: str | None = None, available_now: bool = False,
               name: str | None = None) -> StreamingQuery:
    """K1-K3: append a stream to a zone (Delta when available, else Parquet)."""
    w = (df.writeStream.format(fmt or zone_format(df.sparkSession)).outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", path))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger, available_now).start()


def write_raw(df: DataFrame, path: str, checkpoint: str, trigger: str | None = RAW_TRIGGER,
              **kw) -> StreamingQuery:
    """K1: raw zone append (5 s trigger by default), partitioned by the
    broker's ingest date: raw rows may lack a valid event time, and the date
    layout lets compaction, retention and time-bounded reads prune."""
    if "ingest_date" not in df.columns:
        df = df.withColumn("ingest_date", F.to_date("kafka_ingest_ts"))
    return write_zone(df, path, checkpoint, trigger, partition_by=["ingest_date"], **kw)


def write_clean(df: DataFrame, path: str, checkpoint: str, trigger: str | None = CLEAN_TRIGGER,
                **kw) -> StreamingQuery:
    """K2: clean zone append, partitioned by event_date / event_hour."""
    return write_zone(df, path, checkpoint, trigger, partition_by=["event_date", "event_hour"], **kw)


def write_analytics(df: DataFrame, path: str, checkpoint: str, trigger: str | None = ANALYTICS_TRIGGER,
                    **kw) -> StreamingQuery:
    """K3: analytics zone append, partitioned by window_date (30 s trigger)."""
    return write_zone(df, path, checkpoint, trigger, partition_by=["window_date"], **kw)


def raw_stream(records: DataFrame) -> DataFrame:
    """Raw zone content: decoded events plus broker columns and the original text."""
    return decode_events(records, keep_value=True)


def write_quarantine(df: DataFrame, path: str, checkpoint: str, trigger: str | None = CLEAN_TRIGGER,
                     **kw) -> StreamingQuery:
    """Q3: append the rows that break the contract, with their violations,
    partitioned by ingest date."""
    return write_raw(split_quarantine(df)[1], path, checkpoint, trigger, **kw)


def clean_stream(raw: DataFrame, dedup: bool = False, watermark: str = WATERMARK,
                 count_rejects: bool = False) -> DataFrame:
    """Clean zone content: validated and enriched (optionally de-duplicated, T6).

    ``count_rejects`` attaches the contract's reject counts to every
    micro-batch's progress (Q3)."""
    raw = raw.drop("value", "ingest_date")
    c = enrich(validate(observe_rejects(raw) if count_rejects else raw))
    return dedup_stream(c, watermark) if dedup else c


def analytics_stream(clean: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Analytics zone content: watermarked 5 min / 1 min windows."""
    out = sliding_metrics(clean, watermark=watermark, processing_time=True)
    return out.withColumn("window_date", F.to_date("window_start"))


def run_pipeline(spark: SparkSession, source: Callable[[], DataFrame], base: str,
                 available_now: bool = False, dedup: bool = False, fmt: str | None = None,
                 triggers=(RAW_TRIGGER, CLEAN_TRIGGER, ANALYTICS_TRIGGER),
                 state_store: str | None = None, quarantine: bool = False) -> list[StreamingQuery]:
    """T4: start the raw, clean and analytics queries; each reads the source.

    ``source`` is a zero-argument function returning the Kafka-shaped stream
    (``kafka_source`` or ``file_source``).  ``state_store="rocksdb"`` keeps
    window and de-duplication state in RocksDB (off-heap, spills to local
    disk, checkpointed incrementally) instead of executor heap, for large
    numbers of open windows.  It must be chosen before a checkpoint's first
    run.  ``quarantine`` adds a fourth query that keeps the rows breaking the
    contract, and reject counts in the clean query's progress.
    """
    if state_store == "rocksdb":
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    z = ZonePaths(base)
    fmt = fmt or zone_format(spark)
    q_raw = write_raw(raw_stream(source()), z.raw, z.checkpoint("raw"), triggers[0],
                      fmt=fmt, available_now=available_now)
    clean = clean_stream(raw_stream(source()), dedup=dedup, count_rejects=quarantine)
    q_clean = write_clean(clean, z.clean, z.checkpoint("clean"), triggers[1],
                          fmt=fmt, available_now=available_now)
    analytics = analytics_stream(clean_stream(raw_stream(source()), dedup=dedup))
    q_agg = write_analytics(analytics, z.analytics, z.checkpoint("analytics"), triggers[2],
                            fmt=fmt, available_now=available_now)
    started = [q_raw, q_clean, q_agg]
    if quarantine:
        started.append(write_quarantine(raw_stream(source()), z.quarantine, z.checkpoint("quarantine"),
                                        triggers[1], fmt=fmt, available_now=available_now))
    return started


def run_chained(spark: SparkSession, source: Callable[[], DataFrame], base: str,
                available_now: bool = False, dedup: bool = False, fmt: str | None = None,
                triggers=(RAW_TRIGGER, CLEAN_TRIGGER, ANALYTICS_TRIGGER),
                quarantine: bool = False) -> list[StreamingQuery]:
    """T4, zone-chained: the broker is read once.

    raw <- source;  clean <- stream of the raw zone;  analytics <- stream of
    the clean zone.  Each hop has its own checkpoint and reads the previous
    zone through its commit log, so it is exactly-once end to end while the
    topic is consumed a single time (one third of the broker traffic of
    ``run_pipeline``).  With ``available_now`` the hops run one after another.
    """
    from ..sources.streams import read_zone_stream
    z = ZonePaths(base)
    fmt = fmt or zone_format(spark)
    started = []

    def start(q):
        started.append(q)
        if available_now:
            await_all([q])
        return q

    start(write_raw(raw_stream(source()), z.raw, z.checkpoint("raw"), triggers[0],
                    fmt=fmt, available_now=available_now))
    raw_schema = spark.read.format(fmt).load(z.raw).schema
    if quarantine:
        start(write_quarantine(read_zone_stream(spark, z.raw, raw_schema, fmt), z.quarantine,
                               z.checkpoint("quarantine"), triggers[1], fmt=fmt, available_now=available_now))
    clean = clean_stream(read_zone_stream(spark, z.raw, raw_schema, fmt), dedup=dedup, count_rejects=quarantine)
    start(write_zone(clean, z.clean, z.checkpoint("clean"), triggers[1],
                     partition_by=["event_date", "event_hour"], fmt=fmt, available_now=available_now))
    clean_schema = spark.read.format(fmt).load(z.clean).schema
    analytics = analytics_stream(read_zone_stream(spark, z.clean, clean_schema, fmt))
    start(write_zone(analytics, z.analytics, z.checkpoint("analytics"), triggers[2],
                     partition_by=["window_date"], fmt=fmt, available_now=available_now))
    return started


def await_all(queries: list[StreamingQuery], timeout: float | None = None) -> None:
    """Block until every query ended (availableNow) or re-raise its failure."""
    for q in queries:
        q.awaitTermination(timeout)
        if q.exception() is not None:
            raise RuntimeError(f"streaming query {q.name or q.id} failed: {q.exception()}")


class RunningBaselines:
    """A6 on a stream: rows and vehicles per camera over every batch so far.

    Generation ``k`` of the state is the folder ``batch=k`` under ``path``, written
    after micro-batch ``k`` from the newest generation below ``k`` and the batch's
    own sums (combined map-side, so a camera with a third of all rows is no
    hot key).  Its ``_SUCCESS`` mark makes it count: a batch that fails and is
    run again starts from the same generation below its own and writes its
    folder anew, so nothing is counted twice or lost.  Two generations are kept.
    ``seed`` is the state before the first batch (none: no rows).
    """

    SCHEMA = "camera_id string, n long, vehicles long"

    def __init__(self, spark: SparkSession, path: str, seed: DataFrame | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        if seed is not None and not self._generations():
            self._write(seed, -1)

    def _fs(self):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), root

    def _generations(self) -> list[int]:
        fs, root = self._fs()
        if not fs.exists(root):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(root)]
        numbers = [int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")]
        return sorted(k for k in numbers
                      if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch={k}/_SUCCESS")))

    def _write(self, sums: DataFrame, k: int) -> None:
        sums.write.mode("overwrite").parquet(f"{self.path}/batch={k}")

    def state_before(self, batch_id: int) -> DataFrame:
        older = [k for k in self._generations() if k < batch_id]
        if not older:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/batch={older[-1]}")

    def advance(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Adds the batch and returns the baselines over all rows up to it."""
        self._write(A.merge_baseline_sums(self.state_before(batch_id), A.baseline_sums(batch)), batch_id)
        fs, _ = self._fs()
        for k in [g for g in self._generations() if g < batch_id][:-1]:
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch={k}"), True)
        state = self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/batch={batch_id}")
        return A.baselines_from_sums(state)


def score_stream(clean: DataFrame, model: ForestModel, alerts_path: str, checkpoint: str,
                 baselines: DataFrame | None = None, threshold: float = 0.85, trigger: str | None = "30 seconds",
                 available_now: bool = False, publish_servers: str | None = None,
                 spike_pct: float = A.SPIKE_PCT, min_speed: float = A.MIN_SPEED_ALERT,
                 running: RunningBaselines | None = None) -> StreamingQuery:
    """Score each micro-batch (model-fixed normalisation) and append only
    alerts whose id is not in the table yet (re-run safe).

    Baselines are either fixed (``baselines``) or, with ``running``, the means
    of all rows up to and including the batch being scored.
    """
    if (baselines is None) == (running is None):
        raise ValueError("give either fixed baselines or running ones")
    spark = clean.sparkSession
    # fixed baselines are checked once, not in every micro-batch
    from ..operators.joins import MAX_BROADCAST_ROWS
    from ..session import cut_lineage
    fixed = cut_lineage(baselines) if running is None else None
    checked = fixed is not None and fixed.count() <= MAX_BROADCAST_ROWS
    shared = share_model(spark, model)      # once per stream, not per micro-batch

    def each(batch: DataFrame, batch_id: int) -> None:
        base = fixed if running is None else running.advance(batch, batch_id)
        scored = score_events(batch, model, norm="model", shared=shared)
        alerts = A.build_alerts(scored, base, threshold=threshold, base_checked=checked,
                                spike_pct=spike_pct, min_speed=min_speed)
        A.append_alerts_table(spark, alerts, alerts_path, publish_servers=publish_servers)

    w = clean.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger, available_now).start()
