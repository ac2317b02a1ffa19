"""Work that stops half-way and goes on: outbox, daily close, replay slices, health log, newest alerts."""

import time

import pytest
from pyspark.sql import functions as F

from streetlake.operators import alerts as A
from streetlake.plans import daily_close as DC
from streetlake.plans import tables as TB
from streetlake.sources.streams import file_batch, file_source

SF001 = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.alert_id for r in df.select("alert_id").collect())


@pytest.fixture(scope="module")
def alerts(spark):
    from streetlake.session import checkpoint_dir
    checkpoint_dir(spark)
    return A.append_new_alerts(TB.standin_alerts(spark, SF001), None).checkpoint()


class Broken(RuntimeError):
    pass


@pytest.mark.parametrize("fails", ["before table", "before send", "before mark", None])
def test_outbox_neither_loses_nor_repeats(spark, alerts, tmp_path, monkeypatch, fails):
    path, sent = str(tmp_path / "alerts"), []

    def send(frame):
        if fails == "before send" and not sent:
            fails_once()
        sent.append(sorted(r.alert_id for r in frame.select("alert_id").collect()))

    state = {"left": 1}

    def fails_once():
        if state["left"]:
            state["left"] = 0
            raise Broken()

    write = A.write_alerts
    if fails == "before table":
        monkeypatch.setattr(A, "write_alerts", lambda a, p: (fails_once(), write(a, p)))
    if fails == "before mark":
        def send(frame):    # noqa: F811
            sent.append(sorted(r.alert_id for r in frame.select("alert_id").collect()))
            fails_once()
    early = alerts.filter("alert_type = 'UNUSUAL_COUNT'")
    try:
        A.append_alerts_table(spark, early, path, send=send)
    except Broken:
        assert fails
    A.append_alerts_table(spark, alerts, path, send=send)
    assert ids(spark.read.parquet(path)) == ids(alerts)                 # stored once each
    told = [i for batch in sent for i in batch]
    assert set(told) == {i for i in ids(alerts)}
    if fails != "before mark":                                          # there a batch goes out again, ids and all
        assert len(told) == 2 * len(set(told))                          # once to each of the two topics
    assert A.pending_batches(spark, path) == []
    before = len(sent)
    A.append_alerts_table(spark, alerts, path, send=send)
    assert all(not b for b in sent[before:])


def test_newest_alerts_read_only_the_days_they_need(spark, alerts, tmp_path):
    from streetlake.operators.serving import recent_alerts
    path = str(tmp_path / "alerts")
    timeless = alerts.limit(2).withColumn("created_at", F.lit(None).cast("timestamp")) \
        .withColumn("alert_id", F.concat("alert_id", F.lit("_t")))
    A.write_alerts(alerts.unionByName(timeless), path)
    whole = spark.read.parquet(path).drop("created_date")
    for severity, limit in ((None, 5), ("critical", 3), ("warning", 40), (None, 500)):
        want = recent_alerts(whole, severity, limit).collect()
        assert A.newest_stored_alerts(spark, path, severity, limit).collect() == want
    few = A.newest_stored_alerts(spark, path, None, 5)
    days = {r[0] for r in few.select(F.to_date("created_at")).distinct().collect()}
    read = {f.split("created_date=")[1].split("/")[0] for f in few.inputFiles()}
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [created_date" in plan or "created_date" in plan.split("PartitionFilters")[1][:200]
    assert {str(d) for d in days} <= read


def test_daily_close_goes_on_after_its_last_finished_step(spark, tmp_path, monkeypatch):
    clean = TB.clean(spark, SF001)
    day, live = "2024-01-15", str(tmp_path / "live")
    clean.repartition(3).write.partitionBy("event_date").parquet(live)

    def close(n):
        return DC.daily_close(spark, clean, day, str(tmp_path / f"sum{n}"), refit=False,
                              compact={live: str(tmp_path / f"gen{n}")}, vacuum={str(tmp_path / "none"): []},
                              steps_path=str(tmp_path / f"steps{n}"))
    want = close("whole")
    calls = []
    real = {n: getattr(DC, n) for n in ("replace_day", "compact_zone", "vacuum_zone", "daily_report", "dq_stats")}
    for broken in ("replace_day", "compact_zone", "vacuum_zone", "daily_report"):
        calls.clear()
        for name, fn in real.items():
            def counted(*a, _name=name, _fn=fn, **k):
                calls.append(_name)
                if _name == broken and calls.count(_name) == 1:
                    raise Broken(_name)
                return _fn(*a, **k)
            monkeypatch.setattr(DC, name, counted)
        with pytest.raises(Broken):
            close(broken)
        assert close(broken) == want
        assert all(calls.count(n) == (2 if n == broken else 1) for n in real)
        steps = spark.read.parquet(str(tmp_path / f"steps{broken}"))
        assert steps.count() == steps.select("step").distinct().count() == 5
        assert close(broken) == want and len(calls) == 6        # a finished close does nothing
        a, b = (spark.read.parquet(str(tmp_path / f"sum{n}")).drop("created_at") for n in ("whole", broken))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_slice_of_one_row_changes_nothing_for_the_others(spark, tmp_path):
    from streetlake.plans.replay import replay_sliding_metrics, write_replay
    raw = TB.raw(spark, SF001)
    valid = TB.clean(spark, SF001).select("event_id").limit(1)
    late = raw.join(valid, "event_id", "left_semi").limit(1).select(*raw.columns).withColumn("kafka_ingest_ts", F.lit("2025-06-01").cast("timestamp")) \
        .withColumn("event_ts", F.lit("2025-06-01").cast("timestamp"))
    both = raw.unionByName(late)
    src = str(tmp_path / "src")
    assert write_replay(both, src, files=4) == 4
    files = spark.read.text(src).select("slice_no", "part").distinct().groupBy("slice_no").count().collect()
    assert len(files) == 8 and {r["count"] for r in files} == {4}       # 7 slices and the one row, 4 files each
    assert file_batch(spark, src).count() == both.count()
    # the last slice only moves the watermark past everything before it
    got = replay_sliding_metrics(spark, both, files=4)
    whole = replay_sliding_metrics(spark, raw, files=4)
    assert whole.exceptAll(got).count() == 0 and got.count() > whole.count()


def test_health_log_of_running_streams(spark, tmp_path):
    from streetlake.streaming.health import HealthListener
    src, log = tmp_path / "in", str(tmp_path / "log")
    src.mkdir()
    listener = HealthListener(spark, log)
    spark.streams.addListener(listener)
    try:
        for run in range(2):
            (src / f"f{run}.txt").write_text("one\ntwo\n")
            q = file_source(spark, str(src)).writeStream.queryName("watched").format("noop") \
                .option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="200 milliseconds").start()
            end, rows = time.time() + 60, 0
            while time.time() < end:
                try:
                    rows = spark.read.parquet(log).filter("status = 'running'").select("run_id").distinct().count()
                except Exception:    # noqa: BLE001 - no report yet
                    rows = 0
                if rows > run:
                    break
                time.sleep(0.5)
            assert q.isActive and rows == run + 1        # rows appear while the query runs
            q.stop()
        end = time.time() + 30
        while time.time() < end and spark.read.parquet(log).filter("status = 'stopped'").count() < 2:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    got = spark.read.parquet(log)
    assert got.filter("status = 'stopped'").count() == 2
    reports = got.filter("status = 'running'")
    assert reports.count() == reports.select("run_id", "batch_id").distinct().count()
    assert reports.agg(F.sum(F.regexp_extract("details", r", (\d+) rows", 1).cast("int"))).first()[0] == 4


def test_latency_buckets(spark):
    from streetlake.streaming.health import latency_bucket
    values = [0, 1, 63, 127, 128, 129, 255, 1000, 123456, 2 ** 40 + 12345, -5, None]
    got = spark.createDataFrame([(v,) for v in values], "v long").select("v", latency_bucket(F.col("v")).alias("b")).collect()
    for v, b in got:
        if v is None:
            assert b is None
        else:
            assert b <= max(v, 0) <= b + b / 64 and (max(v, 0) >= 128 or b == max(v, 0))


def test_unnamed_events_are_stored_once(spark, tmp_path):
    """Alerts of events without an id: a run with other baselines stores none of them again."""
    path = str(tmp_path / "alerts")
    c = TB.clean(spark, SF001).withColumn("event_id", F.lit(None).cast("string"))
    scored = TB.clean(spark, SF001).dropna().withColumn("anomaly_score", F.lit(0.9)).limit(40) \
        .withColumn("event_id", F.lit(None).cast("string")).filter("average_speed < 10")
    base = A.baselines(c)
    A.append_alerts_table(spark, A.build_alerts(scored, base), path)
    n = spark.read.parquet(path).count()
    other = base.withColumn("baseline_vehicle_count", F.col("baseline_vehicle_count") + 1e-3)
    A.append_alerts_table(spark, A.build_alerts(scored.withColumn("anomaly_score", F.lit(0.95)), other), path)
    assert spark.read.parquet(path).count() == n
