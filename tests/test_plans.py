"""Plan-level checks: pruning and pushdown on a stored zone, join strategy."""

import datetime as dt

from pyspark.sql import functions as F

from streetlake.operators import serving as S
from streetlake.operators.joins import attach_small
from streetlake.plans import tables as TB
from streetlake.plans.detect import recent_window
from streetlake.sources.streams import read_zone
from tests.conftest import SF001


def _plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def _zone(spark, tmp_path):
    path = str(tmp_path / "clean")
    TB.clean(spark, SF001).write.partitionBy("event_date", "event_hour").parquet(path)
    return read_zone(spark, path, fmt="parquet")


def test_window_scan_prunes_partitions_and_pushes_filters(spark, tmp_path):
    zone = _zone(spark, tmp_path)
    df = recent_window(zone, as_of=dt.datetime(2024, 1, 20, 12), window_hours=48).select("camera_id", "vehicle_count")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(event_date" in plan and "(event_date#" in plan
    assert "PushedFilters: [IsNotNull(event_ts), GreaterThanOrEqual(event_ts," in plan
    assert "ReadSchema: struct<camera_id:string,event_ts:timestamp,vehicle_count:int>" in plan
    full = zone.count()
    assert 0 < df.count() < full


def test_live_metrics_pushes_time_bounds(spark, tmp_path):
    zone = _zone(spark, tmp_path)
    live = S.live_metrics(zone, as_of=dt.datetime(2024, 1, 20, 12), minutes=60)
    plan = _plan(live)
    assert "GreaterThanOrEqual(event_ts," in plan and "LessThanOrEqual(event_ts," in plan
    part = plan[plan.index("PartitionFilters: ["):]
    part = part[:part.index("]")]
    assert "event_date#" in part and "event_hour#" in part      # day and hour directories pruned
    same = S.live_metrics(TB.clean(spark, SF001), as_of=dt.datetime(2024, 1, 20, 12), minutes=60)
    assert live.exceptAll(same.select(*live.columns)).count() == 0
    assert same.count() == live.count()


def test_attach_small_broadcasts_within_bound_and_falls_back(spark):
    big = TB.clean(spark, SF001)
    stats = big.groupBy("camera_id").agg(F.count(F.lit(1)).alias("n"))
    assert "BroadcastHashJoin" in _plan(attach_small(big, stats, "camera_id"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = attach_small(big, stats, "camera_id", max_rows=0)
        joined.count()
        assert "BroadcastHashJoin" not in _plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_peak_hour_ties_take_earliest_and_empty_availability(spark):
    rows = [(dt.datetime(2024, 1, 1, h, 0), 10) for h in (3, 5)]
    df = spark.createDataFrame(rows, "event_ts timestamp, vehicle_count int").withColumn(
        "event_hour", F.hour("event_ts"))
    peak = [r.event_hour for r in S.peak_hours(df).filter("is_peak").collect()]
    assert peak == [3]
    empty = TB.clean(spark, SF001).filter(F.lit(False))
    assert S.availability(empty).count() == 0


def test_read_clean_window_and_day(spark, tmp_path):
    import pytest
    from streetlake.plans.detect import read_clean, read_clean_day
    path = str(tmp_path / "clean")
    TB.clean(spark, SF001).write.partitionBy("event_date", "event_hour").parquet(path)
    w = read_clean(spark, path, as_of=dt.datetime(2024, 1, 20, 12), window_hours=48,
                   columns=["camera_id", "event_ts"], fmt="parquet")
    assert w.columns == ["camera_id", "event_ts"] and w.count() > 0
    assert read_clean_day(spark, path, "2024-01-15", fmt="parquet").count() > 0
    with pytest.raises(ValueError):
        read_clean_day(spark, path, "2030-01-01", fmt="parquet")


def test_partition_range_across_midnight(spark):
    from streetlake.functions.exprs import partition_range
    cells = [(dt.date(2024, 1, d), h) for d in (19, 20, 21, 22) for h in range(24)]
    df = spark.createDataFrame(cells, "event_date date, event_hour int")
    lo, hi = F.lit(dt.datetime(2024, 1, 20, 23, 30)), F.lit(dt.datetime(2024, 1, 21, 0, 30))
    got = sorted((r.event_date.day, r.event_hour) for r in df.filter(partition_range(df.columns, lo, hi)).collect())
    assert got == [(20, 23), (21, 0)]
    lo2, hi2 = F.lit(dt.datetime(2024, 1, 20, 10, 5)), F.lit(dt.datetime(2024, 1, 20, 12, 0))
    got2 = sorted(r.event_hour for r in df.filter(partition_range(df.columns, lo2, hi2)).collect())
    assert got2 == [10, 11, 12]
    assert partition_range(["x"], lo, hi) is None
