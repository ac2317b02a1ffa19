"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this package relies on.  Event-time functions
# (hour, to_date, window) must be evaluated in UTC.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # remove checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Settings for a large cluster (hundreds of executors, tens of TB per job).
# Shuffles start wide and AQE coalesces them to ~256 MB partitions, so no
# reduce task has to hold a large slice of a day's data; skewed joins are
# split; file splits match the partition size; streaming state lives in
# RocksDB (off-heap, spills to local disk).
CLUSTER_PROFILE = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "streetlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, profile: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults applied.

    ``profile="cluster"`` adds ``CLUSTER_PROFILE`` (explicit arguments win).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(SESSION_DEFAULTS)
    if profile == "cluster":
        settings.update(CLUSTER_PROFILE)
    for k, v in settings.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as is.  Only when it
    is unset a private scratch folder is created and registered, on a local
    master only: executors elsewhere would not see it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not conf:
        conf = tempfile.mkdtemp(prefix="streetlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return checkpoint_dir(spark).rstrip("/") + "/" + name


def cut_lineage(df):
    """Materialise a small, bounded intermediate into the shared checkpoint
    folder (reliable ``checkpoint``, never ``localCheckpoint``): losing an
    executor later re-reads it instead of re-running the scan behind it."""
    if df.isStreaming:
        return df
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """Write an intermediate of any size to the shared checkpoint folder and
    read it back: later reads prune its columns, and a lost executor costs one
    re-read.  Removal is left to the retention of that folder."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make ``streetlake`` importable in every Python worker (once per context).

    The Arrow UDFs (forest build and scoring) are defined in this package, so
    executors must import it.  The package is zipped and added with
    ``addPyFile`` (what ``--py-files`` does), which Spark distributes to all
    executors; the zip on the driver is only the staging copy.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_streetlake_shipped", False):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    stage = tempfile.mkdtemp(prefix="streetlake-pyfiles-")
    zpath = os.path.join(stage, "streetlake.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    sc._streetlake_shipped = True
