"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetlake.session import scratch_path, ship_package

__all__ = ["read_table", "stage", "ship_package", "text_bytes", "fold_of", "rows_of", "attach_groups"]

MAX_BROADCAST_ROWS = 200_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (any file system Spark knows)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and read it
    back: its lineage ends there, so a lost executor costs one re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(col: str | Column = "text") -> Column:
    """Text as UTF-8 bytes; null counts as empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def fold_of(doc_id: str | Column, folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (null id: fold 1, never held out)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % folds, F.lit(1))


def rows_of(batch, step: int = 256):
    """Cut an Arrow batch into slices of at most ``step`` rows, so that Python
    holds few texts at a time."""
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, weight: str,
                  max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``rows`` left joined with ``groups`` (staged; one short row per key,
    ``weight`` tells how many of ``rows`` have it).

    Up to ``max_rows`` groups are counted and broadcast.  Of more, those with
    at least a thousandth of the summed weight, a thousand at most, are
    broadcast and the others joined by a shuffle: no key left there is hot.
    """
    found = groups.agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("total")).first()
    if found["n"] <= max_rows:
        return rows.join(F.broadcast(groups), key, "left")
    hot = F.col(weight) * 1000 >= found["total"]
    first = rows.where(F.col(key).isNotNull()).join(F.broadcast(groups.where(hot)), key, "left")
    rest = first.where(F.col(weight).isNull()).select(*rows.columns).join(groups.where(~hot), key, "left")
    alone = rows.where(F.col(key).isNull()).join(groups.where("false"), key, "left")
    return first.where(F.col(weight).isNotNull()).unionByName(rest).unionByName(alone)
