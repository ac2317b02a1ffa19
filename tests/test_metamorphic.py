"""Metamorphic checks: results do not depend on how the input is partitioned."""

import pytest
from pyspark.sql import functions as F

from streetlake.operators import alerts as A
from streetlake.operators import daily as D
from streetlake.operators import quality as Q
from streetlake.operators import serving as S
from streetlake.operators import windows as W
from streetlake.operators.enrich import enrich
from streetlake.plans import tables as TB
from streetlake.sources.fixtures import traffic_raw
from tests.conftest import SF001


def _frames(spark, layout):
    ev = TB.table(spark, SF001, "events")
    ev = ev.coalesce(1) if layout == "one" else ev.repartition(7, "user_id")
    raw = traffic_raw(ev)
    return raw, enrich(Q.validate(raw), processing_time=False)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


OPS = {
    "sliding": lambda raw, c, now: W.sliding_metrics(c),
    "daily": lambda raw, c, now: D.daily_summary(c),
    "dq": lambda raw, c, now: Q.dq_stats(raw),
    "zscore": lambda raw, c, now: Q.zscore_outliers(c),
    "dedup": lambda raw, c, now: Q.dedup_events(raw),
    "live": lambda raw, c, now: S.live_metrics(c, as_of=now, minutes=60 * 24 * 40),
    "hour_over_hour": lambda raw, c, now: S.hour_over_hour(c),
    "availability": lambda raw, c, now: S.availability(c),
    "baselines": lambda raw, c, now: A.baselines(c),
    "top_n": lambda raw, c, now: S.recent_events(c, as_of=now, hours=24 * 40, n=100, max_buckets=8),
}


@pytest.mark.parametrize("name", list(OPS))
def test_partitioning_does_not_change_results(spark, name):
    raw1, c1 = _frames(spark, "one")
    raw7, c7 = _frames(spark, "seven")
    now = TB.as_of(c1)
    assert _same(OPS[name](raw1, c1, now), OPS[name](raw7, c7, now))


def test_replace_day_twice_equals_once(spark, tmp_path):
    _, c = _frames(spark, "seven")
    s = D.daily_summary(c)
    once, twice = str(tmp_path / "once"), str(tmp_path / "twice")
    D.replace_day(s, once)
    D.replace_day(s, twice)
    D.replace_day(s.filter(F.col("summary_date") == F.lit("2024-01-15").cast("date")), twice)
    assert _same(spark.read.parquet(once), spark.read.parquet(twice))
