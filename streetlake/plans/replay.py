"""Replay a table as a stream: the stream == batch check as a job.

The raw events of a scale-factor folder are written as JSON-lines files, the
same number of files for every slice of ingest time (later slices carry later
modification times), under the session's shared checkpoint
folder.  The streaming pipeline then consumes them one slice per micro-batch with
``availableNow``; the analytics zone it leaves behind must equal the batch
window metrics up to the final watermark.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import spread
from ..session import scratch_path, stored
from ..sources.fixtures import to_wire
from ..sources.streams import file_source
from ..streaming.pipeline import analytics_stream, clean_stream, raw_stream, write_zone

SLICE_DAYS = 5
ROWS_PER_FILE = 4_000


def write_replay(raw: DataFrame, path: str, slice_days: int = SLICE_DAYS, files: int | None = None) -> int:
    """Write ``raw`` as JSON lines, one sub-folder per ``slice_days`` of ingest
    time (rows without an ingest time before all others), in one job.

    Returns the number of files of a slice, which are a micro-batch: ``files``,
    or as many as give the largest slice about ROWS_PER_FILE rows a file.
    Every slice has exactly that many; a part without rows is a file with one
    blank line, which carries no event, so a slice of few rows changes nothing
    for the others.  File times, which order a replay, are set slice by slice.
    """
    spark = raw.sparkSession
    secs = slice_days * 86400
    # render the JSON once, numbered within its task: parts are even without a count of each slice
    lines = stored(to_wire(spread(raw)).select(
        "value", F.floor(F.unix_seconds("timestamp") / secs).alias("slice"),
        F.monotonically_increasing_id().alias("n")), "replay-lines")
    held = [(r["slice"], r["count"]) for r in lines.groupBy("slice").count().orderBy("slice").collect()]
    if not held:
        raise ValueError("nothing to replay")
    k = files or max(-(-max(n for _, n in held) // ROWS_PER_FILE), 1)
    # one row per slice of time, so the numbering is a small table
    number = spark.createDataFrame([(s, i) for i, (s, _) in enumerate(held)], "s long, slice_no int")
    blank = spark.range(len(held) * k).select(
        F.lit("").alias("value"), (F.col("id") / k).cast("int").alias("slice_no"), F.pmod("id", F.lit(k)).cast("int").alias("part"))
    numbered = lines.join(F.broadcast(number), F.col("slice").eqNullSafe(F.col("s"))).select(
        "value", "slice_no", F.pmod("n", F.lit(k)).cast("int").alias("part"))
    numbered.unionByName(blank).repartition(len(held) * k, "slice_no", "part") \
        .sortWithinPartitions("slice_no", "part").write.partitionBy("slice_no", "part").text(path)
    set_file_times(spark, path, len(held), k)
    return k


def set_file_times(spark: SparkSession, path: str, slices: int, parts: int) -> None:
    """Give the files of later slices later modification times."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    start = int(time.time() * 1000) - (slices + 1) * 1000
    for i in range(slices):
        for j in range(parts):
            for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/slice_no={i}/part={j}")):
                fs.setTimes(st.getPath(), start + i * 1000, -1)


def replay_sliding_metrics(spark: SparkSession, raw: DataFrame, base: str | None = None,
                           fmt: str = "parquet", state_partitions: int | None = None,
                           files: int | None = None) -> DataFrame:
    """Run the analytics query over a file replay of ``raw`` and return the
    analytics zone (processing-time columns dropped).

    The number of state partitions is fixed when a checkpoint is created; the
    replay uses the cluster's parallelism rather than the session's shuffle
    setting so a small replay does not run hundreds of state tasks per batch.
    """
    base = base or scratch_path(spark, f"replay-{uuid.uuid4().hex}")
    src = f"{base}/source"
    k = write_replay(raw, src, files=files)
    stream = analytics_stream(clean_stream(raw_stream(file_source(spark, src, max_files=k))))
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions or spark.sparkContext.defaultParallelism))
    try:
        q = write_zone(stream, f"{base}/analytics", f"{base}/_checkpoints/analytics", fmt=fmt,
                       partition_by=["window_date"], available_now=True, name=None)
    finally:
        spark.conf.set(key, old)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"replay failed: {q.exception()}")
    return spark.read.format(fmt).load(f"{base}/analytics").drop("agg_ts", "window_date")


def replay_clean_dedup(spark: SparkSession, raw: DataFrame, base: str | None = None,
                       fmt: str = "parquet", state_partitions: int | None = None,
                       files: int | None = None) -> DataFrame:
    """T6 over a file replay: the clean stream de-duplicated by event id within
    the watermark, read back from its sink (broker and processing-time
    columns dropped: a replay carries no offsets)."""
    from ..schema import EVENT_FIELDS
    base = base or scratch_path(spark, f"replay-dedup-{uuid.uuid4().hex}")
    src = f"{base}/source"
    k = write_replay(raw, src, files=files)
    stream = clean_stream(raw_stream(file_source(spark, src, max_files=k)), dedup=True)
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions or spark.sparkContext.defaultParallelism))
    try:
        q = write_zone(stream, f"{base}/clean", f"{base}/_checkpoints/clean", fmt=fmt,
                       partition_by=["event_date"], available_now=True)
    finally:
        spark.conf.set(key, old)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"replay failed: {q.exception()}")
    cols = EVENT_FIELDS + ["speed_index", "congestion_category", "is_peak_hour", "event_date", "event_hour"]
    return spark.read.format(fmt).load(f"{base}/clean").select(*cols)
