"""Zone maintenance for Parquet zones (K8 compaction, K9 retention).

A streaming Parquet sink keeps a ``_spark_metadata`` log that readers trust,
so compaction never rewrites a live zone in place.  Small files of closed
partitions are packed by size into bins; each bin with two files or more
becomes one file of a new generation folder, whose manifest names the files it
replaces.  Whatever no manifest names is read where it lies: large files are
never rewritten, a file that arrives late in a closed day is not lost, and a
second run over an unchanged zone finds nothing to do.  Retention later removes
generations that are no longer current and older than the retention period.
With Delta on the classpath, ``OPTIMIZE``/``VACUUM`` do the same job.
"""

from __future__ import annotations

import time
from itertools import groupby

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import MAX_BROADCAST_ROWS
from ..sources.streams import has_delta


# date partition column of each zone: clean, raw, analytics
ZONE_DATE_COLUMNS = ("event_date", "ingest_date", "window_date")
MANIFEST = "part string, path string, bytes long"


def list_files(spark: SparkSession, root: str) -> DataFrame | None:
    """path, length and partition columns of the data files under ``root`` (through a sink's
    metadata log where there is one); the files themselves are not opened.  None if there are none."""
    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return found.drop("content", "modificationTime")


def zone_files(spark: SparkSession, live: str, generations=(), partition_cols=None, closed_before=None) -> list[tuple]:
    """(partition, path, bytes) of the files that make up a zone: those of ``live`` and of its
    generations that no manifest replaces (of closed partitions, where asked for)."""
    replaced: set[str] = set()
    for g in generations:
        replaced |= {r[0] for r in _read_manifest(spark, g).select("path").collect()}    # as many as files listed
    out: list[tuple] = []
    for root in (live, *generations):
        files = list_files(spark, root)
        if files is None:
            continue
        keys = partition_cols or [c for c in files.columns if c in ZONE_DATE_COLUMNS][:1]
        if closed_before is not None:
            files = files.filter(F.col(keys[0]) < F.lit(str(closed_before)).cast("date"))
        part = F.to_json(F.struct(*[F.col(c) for c in keys])) if keys else F.lit("{}")
        out += [(r[0], r[1], r[2]) for r in files.select(part, "path", "length").collect() if r[1] not in replaced]
    return sorted(out)


def _read_manifest(spark: SparkSession, generation: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).parquet(f"{generation}/_manifest/files")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def _read_files(spark: SparkSession, files: list[str], roots, path_column: str | None = None) -> DataFrame:
    """Files under several roots as one frame, with their paths if asked for;
    partition columns come from each root's layout."""
    out = None
    for root in roots:
        base = _qualified(spark, root)
        mine = [f for f in files if f.startswith(base + "/")]
        if mine:
            part = spark.read.option("basePath", root).parquet(*mine)
            if path_column:
                part = part.withColumn(path_column, F.col("_metadata.file_path"))
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _qualified(spark: SparkSession, path: str) -> str:
    """A folder as the paths of its files name it."""
    fs, p = _fs(spark, path)
    return p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString().rstrip("/")


def pack_small_files(files: list[tuple[str, str, int]], target_bytes: int) -> list[list[tuple[str, str, int]]]:
    """Bins of (partition, path, bytes): first-fit decreasing within each partition.

    Files of three quarters of the target or more stay as they are, and so does
    a file that shares its bin with no other.
    """
    bins: list[list] = []
    for _, group in groupby(sorted(files, key=lambda f: (f[0], -f[2], f[1])), key=lambda f: f[0]):
        open_bins: list[list] = []
        for f in group:
            if f[2] * 4 >= target_bytes * 3:
                continue
            room = next((b for b in open_bins if b[0] + f[2] <= target_bytes), None)
            if room is None:
                room = [0, []]
                open_bins.append(room)
            room[0] += f[2]
            room[1].append(f)
        bins += [b[1] for b in open_bins if len(b[1]) > 1]
    return bins


def compact_zone(spark: SparkSession, src: str, dst: str, partition_cols=None,
                 closed_before=None, sort_cols=("camera_id", "event_ts"),
                 target_mb: float = 128, generations=()) -> str:
    """K8: pack the small files of (closed) partitions of a zone into generation folder ``dst``.

    ``partition_cols`` defaults to the zone's date column (event_date,
    ingest_date or window_date, whichever it has).  Only partitions with
    ``partition_cols[0] < closed_before`` are taken when given, so partitions
    a running stream still appends to are left alone.  ``generations`` are
    those made before; their files may be packed again.  A bin holds at most
    ``target_mb`` and goes to one writer task; rows are sorted by camera and time
    within it, so Parquet statistics skip row groups.  Nothing is written where
    nothing can be packed.  ``read_compacted`` gives the whole zone.  Returns ``dst``.
    """
    if has_delta(spark):
        spark.sql(f"OPTIMIZE delta.`{src}`")
        return src
    generations = finished(spark, generations)
    roots = (src, *generations)
    if partition_cols is None:
        listed = list_files(spark, src)
        partition_cols = [c for c in ZONE_DATE_COLUMNS if listed is not None and c in listed.columns][:1]
    if not partition_cols:
        raise ValueError(f"{src}: no date partition column among {ZONE_DATE_COLUMNS}")
    files = zone_files(spark, src, generations, list(partition_cols), closed_before)
    bins = pack_small_files(files, int(target_mb * 1024 * 1024))
    if not bins:
        return dst
    rows = [(f[0], f[1], f[2], n) for n, b in enumerate(bins) for f in b]
    plan = spark.createDataFrame(rows, MANIFEST + ", bin int")
    small = _read_files(spark, sorted(r[1] for r in rows), roots, "_path")
    place = plan.select(F.col("path").alias("_path"), F.col("bin").alias("_bin"))
    binned = small.join(F.broadcast(place) if len(rows) <= MAX_BROADCAST_ROWS else place, "_path").drop("_path")
    order = [*partition_cols, *[c for c in sort_cols if c in small.columns]]
    (binned.repartition(len(bins), "_bin").drop("_bin").sortWithinPartitions(*order)
     .write.mode("overwrite").partitionBy(*partition_cols).parquet(dst))
    # the manifest comes last: without it the generation is not part of the zone yet
    plan.drop("bin").coalesce(1).write.mode("overwrite").parquet(f"{dst}/_manifest/files")
    return dst


def compacted_files(spark: SparkSession, generation: str) -> int:
    """How many files a generation replaces."""
    return _read_manifest(spark, generation).count()


def read_compacted(spark: SparkSession, live: str, *generations: str) -> DataFrame:
    """The zone as a whole: the files of its generations and those of the
    ``live`` zone that none replaces.  Columns that only one side has are null on the other."""
    kept = finished(spark, generations)
    return _read_files(spark, [f[1] for f in zone_files(spark, live, kept)], (live, *kept))


def finished(spark: SparkSession, generations) -> list[str]:
    """Generations with a manifest; one without was not written to its end."""
    out = []
    for g in generations:
        fs, p = _fs(spark, f"{g}/_manifest")
        if fs.exists(p):
            out.append(g)
    return out


def drop_partition(spark: SparkSession, path: str, column: str, value) -> None:
    """Remove one partition folder of a Parquet table, if it is there."""
    fs, p = _fs(spark, f"{path}/{column}={value}")
    if fs.exists(p):
        fs.delete(p, True)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def vacuum_zone(spark: SparkSession, root: str, retain_hours: float = 168, keep=(),
                prefix: str = "gen=", now_ms: int | None = None) -> list[str]:
    """K9: delete generation folders under ``root`` older than the retention.

    Folders named in ``keep`` (the current generation) are never removed.
    Returns the deleted paths.  Delta zones use ``VACUUM``.
    """
    if has_delta(spark):
        spark.sql(f"VACUUM delta.`{root}` RETAIN {int(retain_hours)} HOURS")
        return []
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    now_ms = now_ms if now_ms is not None else int(time.time() * 1000)
    limit = now_ms - int(retain_hours * 3600 * 1000)
    keep = {k.rstrip("/").rsplit("/", 1)[-1] for k in keep}
    deleted = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if not st.isDirectory() or not name.startswith(prefix) or name in keep:
            continue
        if st.getModificationTime() < limit:
            fs.delete(st.getPath(), True)
            deleted.append(st.getPath().toString())
    return deleted
