"""Structured Streaming pipeline: stream == batch, restart, late and dirty data."""

import json
import os

import pytest
from pyspark.sql import functions as F

from streetlake.operators.enrich import enrich
from streetlake.operators.quality import validate
from streetlake.operators.windows import sliding_metrics
from streetlake.plans import tables as TB
from streetlake.sources.decode import decode_events
from streetlake.sources.streams import file_batch, file_source, kafka_options
from streetlake.streaming.pipeline import await_all, clean_stream, raw_stream, run_pipeline
from tests.conftest import SF001

BASE_MTIME = 1_700_000_000


def _lines(spark):
    w = TB.wire(spark, SF001)
    ordered = w.orderBy(F.col("offset") % 100_000_000, "offset").select("value")
    return [r.value for r in ordered.collect()]


def _write(d, idx, lines):
    os.makedirs(d, exist_ok=True)
    p = os.path.join(d, f"part-{idx:04d}.json")
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(p, (BASE_MTIME + idx, BASE_MTIME + idx))
    return p


def _slices(lines, n):
    size = (len(lines) + n - 1) // n
    return [lines[i:i + size] for i in range(0, len(lines), size)]


def _expected(spark, src_dir):
    clean = enrich(validate(decode_events(file_batch(spark, src_dir), keep_value=False)), processing_time=False)
    mx = clean.agg(F.max("event_ts")).first()[0]
    return clean, sliding_metrics(clean).filter(F.col("window_end") <= F.lit(mx) - F.expr("INTERVAL 10 MINUTES"))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def lines(spark):
    return _lines(spark)


def test_stream_equals_batch(spark, lines, tmp_path):
    src = str(tmp_path / "src")
    for i, chunk in enumerate(_slices(lines, 6)):
        _write(src, i, chunk)
    base = str(tmp_path / "zones")
    qs = run_pipeline(spark, lambda: file_source(spark, src, max_files=1), base, available_now=True, fmt="parquet")
    await_all(qs)
    raw = spark.read.parquet(base + "/raw")
    assert raw.count() == len(lines)
    clean, expected = _expected(spark, src)
    got_clean = spark.read.parquet(base + "/clean")
    assert got_clean.count() == clean.count()
    got = spark.read.parquet(base + "/analytics").drop("agg_ts", "window_date")
    assert got.count() > 0
    assert _same(got.select(*expected.columns), expected)


def test_restart_no_loss_no_duplicates(spark, lines, tmp_path):
    src = str(tmp_path / "src")
    chunks = _slices(lines, 6)
    for i, chunk in enumerate(chunks[:3]):
        _write(src, i, chunk)
    base = str(tmp_path / "zones")
    src_fn = lambda: file_source(spark, src, max_files=1)
    await_all(run_pipeline(spark, src_fn, base, available_now=True, fmt="parquet"))
    first = spark.read.parquet(base + "/raw").count()
    assert first == sum(len(c) for c in chunks[:3])
    for i, chunk in enumerate(chunks[3:], start=3):
        _write(src, i, chunk)
    await_all(run_pipeline(spark, src_fn, base, available_now=True, fmt="parquet"))
    # a third run with nothing new adds nothing
    await_all(run_pipeline(spark, src_fn, base, available_now=True, fmt="parquet"))
    assert spark.read.parquet(base + "/raw").count() == len(lines)
    _, expected = _expected(spark, src)
    got = spark.read.parquet(base + "/analytics").drop("agg_ts", "window_date")
    assert _same(got.select(*expected.columns), expected)


def _event(ts, eid, cam="CAM_01", vc=100):
    return json.dumps({"event_id": str(eid), "camera_id": cam, "timestamp": ts, "location": "L",
                       "latitude": 43.0, "longitude": -79.0, "vehicle_count": vc, "average_speed": 40.0,
                       "congestion_level": "LOW", "congestion_score": 10.0})


def test_late_rows_dropped_from_windows_kept_in_zones(spark, tmp_path):
    """Spark drops late rows against the watermark of the previous batch, so
    the late row arrives two batches after the watermark passed its windows."""
    src = str(tmp_path / "src")
    _write(src, 0, [_event("2024-01-01T10:00:30.000000Z", 1), _event("2024-01-01T10:20:00.000000Z", 2)])
    _write(src, 1, [_event("2024-01-01T10:21:00.000000Z", 3)])
    # 17 minutes behind the max seen: every window it falls in is closed -> dropped
    _write(src, 2, [_event("2024-01-01T10:04:00.000000Z", 4, vc=7)])
    # 9 minutes behind the max seen -> kept in all five windows
    _write(src, 3, [_event("2024-01-01T10:12:00.000000Z", 5, vc=9)])
    _write(src, 4, [_event("2024-01-01T10:40:00.000000Z", 6)])      # flush row
    base = str(tmp_path / "zones")
    await_all(run_pipeline(spark, lambda: file_source(spark, src, max_files=1), base,
                           available_now=True, fmt="parquet"))
    assert spark.read.parquet(base + "/clean").count() == 6
    assert spark.read.parquet(base + "/raw").count() == 6
    an = spark.read.parquet(base + "/analytics")
    assert an.filter(F.col("min_vehicle_count") == 7).count() == 0
    assert an.filter(F.col("min_vehicle_count") == 9).count() == 5


def test_dirty_lines_quarantined_not_fatal(spark, tmp_path):
    src = str(tmp_path / "src")
    extra_field = _event("2024-01-01T10:00:00Z", 11)[:-1] + ', "unknown_field": 1}'
    dirty = ["not json", "", "{}", '{"vehicle_count":"x"}', _event("yesterday-ish", 10), extra_field]
    _write(src, 0, dirty)
    base = str(tmp_path / "zones")
    await_all(run_pipeline(spark, lambda: file_source(spark, src, max_files=1), base,
                           available_now=True, fmt="parquet"))
    raw = spark.read.parquet(base + "/raw")
    assert raw.count() == len(dirty)
    assert raw.filter(F.col("event_id") == "10").first()["event_ts"] is None
    clean = spark.read.parquet(base + "/clean")
    assert [r.event_id for r in clean.collect()] == ["11"]


def test_stream_dedup_within_watermark(spark, lines, tmp_path):
    src = str(tmp_path / "src")
    for i, chunk in enumerate(_slices(lines, 4)):
        _write(src, i, chunk)
    stream = clean_stream(raw_stream(file_source(spark, src, max_files=1)), dedup=True)
    q = (stream.writeStream.format("memory").queryName("dedup_out").trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination()
    got = spark.table("dedup_out")
    assert got.count() == got.select("event_id").distinct().count()
    clean, _ = _expected(spark, src)
    assert got.count() == clean.select("event_id").distinct().count()


def test_kafka_source_options():
    opts = kafka_options("broker:9092")
    assert opts["subscribe"] == "traffic.raw.events"
    assert opts["startingOffsets"] == "latest"
    assert opts["maxOffsetsPerTrigger"] == 5000
    assert opts["failOnDataLoss"] == "false"


def test_observed_reject_counts_on_stream(spark, lines, tmp_path):
    from streetlake.operators.quality import observe_rejects
    src = str(tmp_path / "src")
    _write(src, 0, lines)
    raw = observe_rejects(raw_stream(file_source(spark, src, max_files=1)), "rejects")
    q = (raw.writeStream.format("noop").trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination()
    seen = [p["observedMetrics"]["rejects"] for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(m["total_rows"] for m in seen) == len(lines)
    from streetlake.operators.quality import reject_stats
    expected = {r.rule: r.rejected_rows for r in reject_stats(
        decode_events(file_batch(spark, src))).collect()}
    assert sum(m["any"] for m in seen) == expected["any"]


def test_score_stream_appends_alerts_once(spark, tmp_path):
    from streetlake.operators.alerts import baselines
    from streetlake.operators.iforest import fit_forest
    from streetlake.sources.streams import read_zone_stream
    from streetlake.streaming.pipeline import score_stream
    clean = TB.clean(spark, SF001)
    model = fit_forest(clean, n_trees=30, calibrate=True)
    zone = str(tmp_path / "clean")
    clean.write.partitionBy("event_date").parquet(zone)
    ap = str(tmp_path / "alerts")
    for run in range(2):                      # second run: nothing new, nothing appended
        stream = read_zone_stream(spark, zone, schema=spark.read.parquet(zone).schema, fmt="parquet")
        q = score_stream(stream, model, ap, str(tmp_path / "ck"), baselines(clean), threshold=0.8,
                         available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    alerts = spark.read.parquet(ap)
    assert alerts.count() > 0
    assert alerts.count() == alerts.select("alert_id").distinct().count()


def test_running_baselines_equal_batch_over_the_prefix(spark, tmp_path):
    """Alerts of each micro-batch are those of a batch run with the baselines of all rows so far,
    also where a batch is run twice."""
    from streetlake.operators import alerts as A
    from streetlake.operators.iforest import fit_forest, score_events
    from streetlake.sources.streams import read_zone_stream
    from streetlake.streaming.pipeline import RunningBaselines, score_stream
    clean = TB.clean(spark, SF001).dropDuplicates(["event_id"])
    model = fit_forest(clean, n_trees=20, calibrate=True)
    zone, ap, state = (str(tmp_path / x) for x in ("clean", "alerts", "state"))
    expected = set()
    for k in range(3):                          # one run, and so one micro-batch, a third
        part = clean.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == k)
        part.coalesce(1).write.mode("append").parquet(zone)
        prefix = clean.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) <= k)
        want = A.build_alerts(score_events(part, model, norm="model"), A.baselines(prefix), threshold=0.7)
        expected |= {tuple(r) for r in want.select("alert_id", "message", "baseline_vehicle_count",
                                                   "pct_above_baseline").collect()}
        q = score_stream(read_zone_stream(spark, zone, schema=clean.schema, fmt="parquet"), model, ap,
                         str(tmp_path / "ck"), threshold=0.7, available_now=True,
                         running=RunningBaselines(spark, state))
        q.awaitTermination()
        assert q.exception() is None
    got = {tuple(r) for r in spark.read.parquet(ap).select(
        "alert_id", "message", "baseline_vehicle_count", "pct_above_baseline").collect()}
    assert got == expected and len(got) > 3
    running = RunningBaselines(spark, state)
    last = running._generations()[-1]
    before = sorted(map(tuple, spark.read.parquet(f"{state}/batch={last}").collect()))
    part = clean.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == 2)
    again = running.advance(part, last)         # the last batch once more: the same state
    assert sorted(map(tuple, spark.read.parquet(f"{state}/batch={last}").collect())) == before
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, A.baselines(clean).collect()))
    assert len(running._generations()) <= 2
    empty = running.advance(clean.limit(0), last + 1)     # a batch without rows changes nothing
    assert sorted(map(tuple, empty.collect())) == sorted(map(tuple, A.baselines(clean).collect()))
    with pytest.raises(ValueError):
        score_stream(clean, model, ap, "x")


def test_jdbc_options_wiring():
    from streetlake.sources.jdbc import jdbc_options
    o = jdbc_options("jdbc:postgresql://db/x", "clean_events", partition_column="id", lower=0, upper=100,
                     num_partitions=4)
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == ("id", "0", "100", "4")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def test_rocksdb_state_store_pipeline(spark, lines, tmp_path):
    src = str(tmp_path / "src")
    for i, chunk in enumerate(_slices(lines, 3)):
        _write(src, i, chunk)
    base = str(tmp_path / "zones")
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        await_all(run_pipeline(spark, lambda: file_source(spark, src, max_files=1), base,
                               available_now=True, fmt="parquet", state_store="rocksdb"))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    _, expected = _expected(spark, src)
    got = spark.read.parquet(base + "/analytics").drop("agg_ts", "window_date")
    assert _same(got.select(*expected.columns), expected)


def test_chained_zones_read_source_once(spark, lines, tmp_path):
    from streetlake.streaming.pipeline import run_chained
    src = str(tmp_path / "src")
    for i, chunk in enumerate(_slices(lines, 3)):
        _write(src, i, chunk)
    base = str(tmp_path / "zones")
    await_all(run_chained(spark, lambda: file_source(spark, src, max_files=1), base,
                          available_now=True, fmt="parquet"))
    assert spark.read.parquet(base + "/raw").count() == len(lines)
    clean, expected = _expected(spark, src)
    assert spark.read.parquet(base + "/clean").count() == clean.count()
    got = spark.read.parquet(base + "/analytics").drop("agg_ts", "window_date")
    assert _same(got.select(*expected.columns), expected)


def test_progress_rows_from_finished_queries(spark, lines, tmp_path):
    from streetlake.streaming.health import progress_rows
    src = str(tmp_path / "src")
    _write(src, 0, lines[:50])
    qs = run_pipeline(spark, lambda: file_source(spark, src, max_files=1), str(tmp_path / "zones"),
                      available_now=True, fmt="parquet")
    await_all(qs)
    rows = progress_rows(qs)
    assert len(rows) == 3 and all(r[1] == "stopped" for r in rows)
    assert all("rows" in r[3] for r in rows)


def test_compact_every_zone_of_a_pipeline(spark, lines, tmp_path):
    from streetlake.plans.maintenance import compact_zone, compacted_files, read_compacted
    src = str(tmp_path / "src")
    for i, chunk in enumerate(_slices(lines, 3)):
        _write(src, i, chunk)
    base = str(tmp_path / "zones")
    await_all(run_pipeline(spark, lambda: file_source(spark, src, max_files=1), base,
                           available_now=True, fmt="parquet"))
    for zone in ("raw", "clean", "analytics"):
        before = spark.read.parquet(f"{base}/{zone}")
        gen = compact_zone(spark, f"{base}/{zone}", str(tmp_path / f"{zone}_gen1"))
        assert compacted_files(spark, gen) > 0
        after = read_compacted(spark, f"{base}/{zone}", gen).select(*before.columns)
        assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0, zone


def test_replay_with_several_files_a_slice(spark):
    from streetlake.plans.replay import replay_sliding_metrics
    raw = TB.raw(spark, SF001)
    assert _same(replay_sliding_metrics(spark, raw, files=1), replay_sliding_metrics(spark, raw, files=4))


def test_replay_keeps_rows_without_ingest_time(spark, tmp_path):
    from streetlake.plans.replay import write_replay
    raw = TB.raw(spark, SF001)
    raw = raw.withColumn("kafka_ingest_ts", F.when(F.col("kafka_offset") % 2 == 0, F.col("kafka_ingest_ts")))
    write_replay(raw, str(tmp_path / "src"))
    assert file_batch(spark, str(tmp_path / "src")).count() == raw.count()


@pytest.mark.parametrize("chained", [False, True])
def test_quarantine_keeps_rejected_rows(spark, lines, tmp_path, chained):
    from streetlake.operators.quality import split_quarantine
    from streetlake.streaming.pipeline import run_chained
    src, base = str(tmp_path / "src"), str(tmp_path / "zones")
    _write(src, 0, lines)
    qs = (run_chained if chained else run_pipeline)(
        spark, lambda: file_source(spark, src, max_files=1), base, available_now=True, fmt="parquet", quarantine=True)
    await_all(qs)
    want = split_quarantine(decode_events(file_batch(spark, src), keep_value=False))[1]
    got = spark.read.parquet(base + "/quarantine")
    assert got.count() == want.count() > 0
    assert got.filter(F.size("violations") == 0).count() == 0
    seen = [p["observedMetrics"]["contract_rejects"] for q in qs for p in q.recentProgress
            if "contract_rejects" in (p["observedMetrics"] or {})]
    assert sum(m["any"] for m in seen) == want.count()
