"""Zone freshness and the pipeline-health log.

Health is computed from the data, not hard-coded: for each zone the newest
event time, row count and processing lag percentiles, classified as
running / degraded / down by how far the newest event trails ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions import exprs as X

DEGRADED_AFTER_S = 60
DOWN_AFTER_S = 600


def zone_freshness(zones: dict[str, DataFrame], as_of=None, ts_col: str = "event_ts",
                   degraded_after_s: int = DEGRADED_AFTER_S, down_after_s: int = DOWN_AFTER_S) -> DataFrame:
    """One row per zone in the health-log shape.

    component, status, latency_ms (p50 pipeline lag), p99_latency_ms, rows,
    max_event_ts, lag_seconds, details, logged_at.  Percentiles come from a
    mergeable histogram (``latency_bucket``).
    """
    now = X.ts_value(as_of)
    parts = []
    for name, df in zones.items():
        t = F.col(ts_col)
        if "pipeline_ts" in df.columns:
            lag_ms = F.expr(f"(unix_micros(pipeline_ts) - unix_micros({ts_col})) div 1000")
        else:
            lag_ms = F.lit(None).cast("long")
        hist = df.groupBy(latency_bucket(lag_ms).alias("bucket")).agg(
            F.count(F.lit(1)).alias("n"), F.max(t).alias("newest"))
        agg = hist.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.max("newest").alias("max_event_ts"),
                       F.sort_array(F.collect_list(F.when(F.col("bucket").isNotNull(), F.struct("bucket", "n"))))
                       .alias("lags"))
        parts.append(agg.select(F.lit(name).alias("component"), "rows", "max_event_ts",
                                histogram_percentile("lags", 0.5).alias("latency_ms"),
                                histogram_percentile("lags", 0.99).alias("p99_latency_ms")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    lag_s = (F.unix_micros(now) - F.unix_micros("max_event_ts")) / 1e6
    status = (F.when(F.col("max_event_ts").isNull() | (lag_s > down_after_s), "down")
              .when(lag_s > degraded_after_s, "degraded").otherwise("running"))
    return out.select(
        "component", status.alias("status"), "latency_ms", "p99_latency_ms", "rows", "max_event_ts",
        lag_s.alias("lag_seconds"),
        F.format_string("%d rows, newest event %s", F.col("rows"), F.col("max_event_ts").cast("string"))
        .alias("details"),
        now.alias("logged_at"))


# Leading bits of a latency that its bucket keeps: buckets are at most a 64th
# of their lower bound wide, so a percentile is at most 1/64 too low.
LATENCY_BITS = 7


def latency_bucket(ms: Column) -> Column:
    """Lower bound of a latency's bucket (whole milliseconds; negative ones count as 0).

    Counts per bucket add up over any split of the rows, and there are at most
    64 buckets for each power of two, whatever the number of rows.
    """
    v = F.when(ms < 0, F.lit(0).cast("long")).otherwise(ms)
    low_bits = F.greatest(F.length(F.bin(v)) - LATENCY_BITS, F.lit(0))
    return v - F.pmod(v, F.pow(F.lit(2.0), low_bits).cast("long"))


def histogram_percentile(buckets: str, p: float) -> Column:
    """Least bucket that holds a share ``p`` of an array of (bucket, n), in order; null for none."""
    total = F.aggregate(buckets, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    need = F.ceil(total * F.lit(p))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at"))
    return F.aggregate(buckets, start, lambda a, x: F.struct(
        (a["seen"] + x["n"]).alias("seen"),
        F.when(a["at"].isNull() & (a["seen"] + x["n"] >= need), x["bucket"]).otherwise(a["at"]).alias("at")),
        lambda a: a["at"].cast("double"))


def progress_rows(queries: list[StreamingQuery]) -> list[tuple]:
    """Health-log rows from the queries' last progress (small driver metadata)."""
    rows = []
    for q in queries:
        p = q.lastProgress or {}
        dur = (p.get("durationMs") or {}).get("triggerExecution")
        status = "running" if q.isActive else ("down" if q.exception() else "stopped")
        rows.append((q.name or str(q.id), status, float(dur) if dur is not None else None,
                     f"batch {p.get('batchId')}, {p.get('numInputRows', 0)} rows"))
    return rows


HEALTH_SCHEMA = "component string, status string, latency_ms double, details string"


def write_health(spark, queries: list[StreamingQuery], path: str, at=None) -> None:
    """Append one health-log row per query to the table at ``path``."""
    rows = spark.createDataFrame(progress_rows(queries), HEALTH_SCHEMA)
    rows.withColumn("logged_at", X.ts_value(at)).coalesce(1).write.mode("append").parquet(path)


class HealthListener(StreamingQueryListener):
    """Appends a health-log row for every progress report of every query,
    while the queries run (``spark.streams.addListener``), and one when a query ends.

    Rows carry the run and batch of the report, so a log that several runs
    append to still tells each report once.
    """

    SCHEMA = HEALTH_SCHEMA + ", run_id string, batch_id long, logged_at timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.names: dict[str, str] = {}

    def _append(self, component, status, ms, details, run_id, batch_id) -> None:
        self.spark.createDataFrame([(component, status, ms, details, run_id, batch_id)],
                                   self.SCHEMA.rsplit(",", 1)[0]) \
            .withColumn("logged_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._append(p.name or str(p.id), "running", float(p.durationMs.get("triggerExecution", 0)),
                     f"batch {p.batchId}, {p.numInputRows} rows", str(p.runId), int(p.batchId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        failed = bool(event.exception)
        self._append(self.names.pop(run, str(event.id)), "down" if failed else "stopped", None,
                     str(event.exception)[:500] if failed else "ended", run, -1)
