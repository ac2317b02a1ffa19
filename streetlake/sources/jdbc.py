"""JDBC source and sink.

Reads push filters and column pruning down to the database and split the
scan over ``num_partitions`` ranges of a numeric/date column; writes go
through Spark's JDBC writer (streams via ``foreachBatch``).  A database is
never started here: callers pass the URL of theirs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower=None, upper=None, num_partitions: int | None = None,
                 fetchsize: int = 10_000) -> dict:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetchsize)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partition_column needs lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower),
                    upperBound=str(upper), numPartitions=str(num_partitions))
    return opts


def jdbc_table(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    """A table (or ``(SELECT ...) t`` text) as a partitioned DataFrame."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kw)).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 10_000,
               num_partitions: int | None = None, **kw) -> None:
    """Append (or overwrite) a frame into a table."""
    opts = jdbc_options(url, table, **{k: v for k, v in kw.items()
                                       if k in ("user", "password", "driver")})
    opts["batchsize"] = str(batchsize)
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    df.write.format("jdbc").options(**opts).mode(mode).save()


def jdbc_batch_writer(url: str, table: str, **kw):
    """A ``foreachBatch`` function appending each micro-batch to a table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_jdbc(batch, url, table, **kw)
    return write


def append_new_jdbc(spark: SparkSession, df: DataFrame, url: str, table: str, key: str,
                    key_query: str | None = None, **kw) -> DataFrame:
    """Insert-if-absent into a database table (the ON CONFLICT DO NOTHING case).

    The table's existing keys are read over JDBC (optionally restricted by
    ``key_query``, e.g. a time range, so the read stays small), the batch is
    anti-joined on ``key`` and only new rows are appended.  Returns the rows
    written.  Concurrent writers still need the table's unique constraint.
    """
    src = key_query or f"(SELECT {key} FROM {table}) existing_keys"
    keys = jdbc_table(spark, url, src, **{k: v for k, v in kw.items() if k in ("user", "password", "driver")})
    fresh = df.dropDuplicates([key]).join(keys.select(key), key, "left_anti")
    write_jdbc(fresh, url, table, **kw)
    return fresh
