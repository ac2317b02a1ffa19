"""Unit tests: boundaries, tie-breaks, empty input, idempotence, invariants."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from streetlake.functions import exprs as X
from streetlake.functions.registry import camera_registry, upsert_registry
from streetlake.operators import alerts as A
from streetlake.operators import daily as D
from streetlake.operators import quality as Q
from streetlake.operators import serving as S
from streetlake.operators.enrich import enrich
from streetlake.operators.iforest import brute_force_scores, fit_forest, score_events, score_raw
from streetlake.plans import tables as TB
from streetlake.plans.daily_close import QualityGateFailed, daily_close
from streetlake.plans.detect import detect
from streetlake.plans import maintenance as M
from streetlake.plans.maintenance import compact_zone, vacuum_zone
from streetlake.schema import FEATURE_COLS
from tests.conftest import SF001

EV_COLS = ("event_id string, camera_id string, event_ts timestamp, location string, latitude double, "
           "longitude double, vehicle_count int, average_speed double, congestion_level string, "
           "congestion_score double, accident_detected boolean, pedestrian_count int, heavy_vehicle_pct double")
T0 = dt.datetime(2024, 1, 1, 8, 0, 0)


def ev(spark, rows):
    return spark.createDataFrame(rows, EV_COLS)


def row(eid="1", cam="CAM_01", ts=T0, vc=100, spd=50.0, score=10.0, lat=43.0, lon=-79.0,
        level="LOW", acc=False, ped=0, heavy=1.0, loc="L"):
    return (eid, cam, ts, loc, lat, lon, vc, spd, level, score, acc, ped, heavy)


def test_validity_bounds_inclusive_and_nulls_fail(spark):
    rows = [row("a", vc=0), row("b", vc=2000), row("c", vc=2001), row("d", spd=200.0), row("e", spd=200.1),
            row("f", score=100.0), row("g", score=-0.1), row("h", lat=-90.0), row("i", lat=90.1),
            row("j", lon=180.0), row("k", lon=-180.1), row("l", cam=None), row("m", ts=None),
            row("n", vc=None), row("o", spd=None)]
    got = sorted(r.event_id for r in Q.validate(ev(spark, rows)).collect())
    assert got == ["a", "b", "d", "f", "h", "j"]


def test_contract_rules(spark):
    rows = [row("ok", level="CRITICAL", score=75.0), row("p", cam="CAM_1"), row("q", cam="XCAM_01"),
            row("r", level="CRITICAL", score=74.99), row("s", level="SEVERE"), row("t", ped=-1),
            row("u", heavy=100.5), row("v", loc=None)]
    v = {r.event_id: r.violations for r in Q.violations(ev(spark, rows)).collect()}
    assert v["ok"] == []
    assert v["p"] == ["camera_id_pattern"] and v["q"] == ["camera_id_pattern"]
    assert v["r"] == ["critical_below_min_score"]
    assert v["s"] == ["congestion_level_enum"]
    assert v["t"] == ["pedestrian_count_range"]
    assert v["u"] == ["heavy_vehicle_pct_range"]
    assert v["v"] == ["location_missing"]
    good, bad = Q.split_quarantine(ev(spark, rows))
    assert good.count() == 1 and bad.count() == 7


def test_category_and_status_cut_points(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 24.99, 25.0, 49.99, 50.0, 74.99, 75.0, 100.0)], "s double")
    out = df.select(X.congestion_category("s").alias("c"), X.congestion_status("s").alias("t")).collect()
    assert [r.c for r in out] == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL", "CRITICAL"]
    assert [r.t for r in out] == ["normal", "normal", "medium", "medium", "high", "high", "critical", "critical"]


def test_enrich_speed_index_not_clamped_and_peak(spark):
    df = enrich(ev(spark, [row("a", spd=200.0, ts=dt.datetime(2024, 1, 1, 7, 0)),
                           row("b", spd=60.0, ts=dt.datetime(2024, 1, 1, 10, 0))]), processing_time=False)
    r = {x.event_id: x for x in df.collect()}
    assert r["a"].speed_index == 1.6667 and r["a"].is_peak_hour and r["a"].event_hour == 7
    assert r["b"].speed_index == 0.5 and not r["b"].is_peak_hour


def test_defaults_applied(spark):
    df = ev(spark, [row("a", acc=None, ped=None, heavy=None, score=12.345)])
    df = df.withColumn("producer_version", F.lit(None).cast("string")).withColumn(
        "schema_version", F.lit(None).cast("string"))
    r = Q.apply_defaults(df).first()
    assert (r.accident_detected, r.pedestrian_count, r.heavy_vehicle_pct) == (False, 0, 0.0)
    assert (r.producer_version, r.schema_version, r.congestion_score) == ("2.4.1", "1.0", 12.35)


def test_dq_stats_null_event_id_counts_once(spark):
    rows = [row("a"), row("a"), row(None), row(None), row("b", cam=None, vc=None)]
    s = Q.dq_stats(ev(spark, rows), by_date=False).first()
    assert s.total == 5
    assert s.dup_rate == round(2 / 5, 4)          # second "a", second null
    assert s.null_rate == round((1 / 5 + 1 / 5 + 0 / 5) / 3, 4)
    g = Q.dq_gate(Q.dq_stats(ev(spark, rows), by_date=False)).first()
    assert g.decision == "quality_fail"


def test_dedup_keeps_earliest_ingest(spark):
    raw = TB.raw(spark, SF001)
    d = Q.dedup_events(raw)
    assert d.count() == raw.select("event_id").distinct().count()
    assert d.filter(F.col("kafka_offset") >= 100_000_000).count() == 0


def test_latest_per_camera_tiebreak(spark):
    rows = [row("1", vc=1), row("2", vc=2), row("3", vc=3, ts=T0 - dt.timedelta(minutes=1))]
    r = S.latest_per_camera(ev(spark, rows), as_of=T0, minutes=5).first()
    assert r.vehicle_count == 2                   # same time: larger event_id wins


def test_recent_alerts_limit_validation(spark):
    with pytest.raises(ValueError):
        S.recent_alerts(spark.range(1), limit=501)


def test_throughput_zero_filled(spark):
    rows = [row("1", ts=T0), row("2", ts=T0), row("3", ts=T0 - dt.timedelta(seconds=3))]
    out = S.throughput(ev(spark, rows), as_of=T0, points=5, bucket_seconds=1).orderBy("bucket_start").collect()
    assert [r.events for r in out] == [0, 1, 0, 0, 2]


def test_classify_first_match_order(spark):
    base = spark.createDataFrame([("CAM_01", 100.0)], "camera_id string, baseline_vehicle_count double")
    rows = [row("acc", spd=5.0, acc=True, vc=900), row("spike", spd=50.0, vc=400),
            row("low", spd=9.9, vc=100), row("norm", spd=50.0, vc=150)]
    df = ev(spark, rows).withColumn("anomaly_score", F.lit(0.9))
    out = {r.event_id: r for r in A.alert_records(A.classify(A.with_baseline(df, base))).collect()}
    assert out["acc"].alert_type == "ACCIDENT" and out["acc"].severity == "CRITICAL"
    assert out["spike"].alert_type == "TRAFFIC_SPIKE" and out["spike"].pct_above_baseline == 297.0
    assert out["low"].alert_type == "LOW_SPEED" and out["low"].severity == "WARNING"
    assert out["norm"].alert_type == "UNUSUAL_COUNT"
    assert out["spike"].message == ("Anomaly detected: CAM_01 has 297.0% higher vehicle count than normal "
                                    "(400 vs baseline 100).")
    assert out["low"].message == "CAM_01 reporting critically low speed: 9.9 km/h. Possible blockage."
    assert out["norm"].message == "Unusual vehicle count on CAM_01: 150 (anomaly score 0.900)."


def test_insert_if_absent_and_acks(spark):
    alerts = TB.standin_alerts(spark, SF001)
    first = A.append_new_alerts(alerts, None)
    again = A.append_new_alerts(alerts, first)
    assert again.count() == 0
    acks = spark.createDataFrame([("nope", T0)], "alert_id string, acked_at timestamp")
    acks = A.acknowledge(acks, [first.first().alert_id], T0)
    assert [r.alert_id for r in A.unknown_acks(first, acks).collect()] == ["nope"]
    assert A.alerts_with_ack(first, acks).filter("acknowledged").count() == 1


def test_registry_upsert_keeps_existing(spark):
    reg = camera_registry(spark)
    new = spark.createDataFrame([("CAM_01", "Elsewhere", 1.0, 1.0, "Z", True),
                                 ("CAM_99", "New", 1.0, 2.0, None, True)], reg.schema)
    out = {r.camera_id: r for r in upsert_registry(reg, new).collect()}
    assert len(out) == 13 and out["CAM_01"].location == "Main St / 5th Ave" and out["CAM_99"].zone is None


# --- forest ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def forest(spark):
    clean = TB.clean(spark, SF001)
    return clean, fit_forest(clean, n_trees=50)


def test_forest_scores_match_brute_force(spark, forest):
    clean, model = forest
    sample = clean.dropna(subset=FEATURE_COLS).orderBy("event_id", "kafka_offset").limit(40)
    got = score_raw(sample, model).orderBy("event_id", "kafka_offset").toPandas()
    expect = brute_force_scores(model, got[FEATURE_COLS].to_numpy(dtype=float))
    assert np.allclose(got["anomaly_raw"].to_numpy(), expect, rtol=0, atol=1e-12)
    assert (got["anomaly_raw"] <= 0).all() and (got["anomaly_raw"] >= -1).all()


def test_forest_independent_of_partitioning(spark, forest):
    clean, model = forest
    other = fit_forest(clean.repartition(3, "camera_id"), n_trees=50)
    a = model.nodes.sort_values(["tree", "node"]).reset_index(drop=True)
    b = other.nodes.sort_values(["tree", "node"]).reset_index(drop=True)
    assert a.equals(b)


def test_forest_ranks_injected_spike_highest(spark, forest):
    clean, model = forest
    spike = (clean.limit(1).withColumn("vehicle_count", F.lit(2000)).withColumn("average_speed", F.lit(1.0))
             .withColumn("pedestrian_count", F.lit(500)).withColumn("event_id", F.lit("spike")))
    scored = score_events(clean.unionByName(spike), model)
    n = scored.count()
    s = scored.filter(F.col("event_id") == "spike").first().anomaly_score
    rank = scored.filter(F.col("anomaly_score") > s).count()
    assert rank <= 0.01 * n and s >= 0.85
    lo, hi = scored.agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert abs(lo) < 1e-6 and abs(hi - 1.0) < 1e-6


@pytest.mark.parametrize("pool_factor", [2, 1000])
def test_forest_on_both_sides_of_the_pool(spark, pool_factor):
    clean = TB.clean(spark, SF001).withColumn("event_id", F.lit(None).cast("string")) \
        .withColumn("kafka_offset", F.lit(None).cast("long"))
    model = fit_forest(clean, n_trees=10, psi=16, pool_factor=pool_factor, calibrate=True)
    roots = model.nodes[model.nodes.node == 0]
    assert len(roots) == 10 and (roots["size"] == 16).all()
    lo, hi = score_events(clean, model, norm="model").agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert 0.0 <= lo and hi <= 1.0


def test_forest_of_repeated_rows_and_short_pool(spark):
    one = TB.clean(spark, SF001).dropna(subset=FEATURE_COLS).limit(1)
    same = one.crossJoin(spark.range(40)).drop("id")
    model = fit_forest(same, n_trees=3, psi=16)
    assert list(model.nodes["size"]) == [16, 16, 16]         # nothing to split on
    with pytest.raises(ValueError, match="pool_factor"):
        fit_forest(TB.clean(spark, SF001), n_trees=1, psi=64, pool_factor=0.2)
    assert fit_forest(same.limit(0), n_trees=3) is None


def test_stored_acknowledgements(spark, tmp_path):
    from streetlake.operators.alerts import alerts_with_ack, store_acks, write_alerts
    alerts, acks = str(tmp_path / "alerts"), str(tmp_path / "acks")
    write_alerts(TB.alerts_table(spark, SF001).drop("acknowledged", "acknowledged_at"), alerts)
    ids = [r[0] for r in spark.read.parquet(alerts).orderBy("alert_id").limit(2).collect()]
    assert store_acks(spark, alerts, acks, [*ids, "CAM_01_1_LOW_SPEED_none", "junk"], "2024-02-01 00:00:00") \
        == ["CAM_01_1_LOW_SPEED_none", "junk"]
    assert store_acks(spark, alerts, acks, ["junk"]) == ["junk"]
    t = alerts_with_ack(spark.read.parquet(alerts), spark.read.parquet(acks)).filter("acknowledged")
    assert sorted(r[0] for r in t.select("alert_id").collect()) == ids


def test_constant_columns_have_no_spread(spark):
    from streetlake.operators.iforest import fit_scaler
    df = spark.range(997).select(F.lit("CAM_01").alias("camera_id"), F.lit(5).alias("vehicle_count"),
                                 F.lit(44.44).alias("average_speed"))
    got = {r["feature"]: (r["mean"], r["std"]) for r in fit_scaler(df, ["vehicle_count", "average_speed"]).collect()}
    assert got == {"vehicle_count": (5.0, 1.0), "average_speed": (44.44, 1.0)}
    assert Q.zscore_outliers(df).first()["outlier_rows"] == 0


def test_replace_day_by_no_rows(spark, tmp_path):
    path = str(tmp_path / "daily")
    s = D.daily_summary(TB.clean(spark, SF001))
    D.replace_day(s, path)
    D.replace_day(s.limit(0), path, date="2024-01-15")
    days = {str(r[0]) for r in spark.read.parquet(path).select("summary_date").distinct().collect()}
    assert "2024-01-15" not in days and len(days) > 1


def test_compacted_and_live_days_together(spark, tmp_path):
    from streetlake.plans.maintenance import read_compacted
    clean = TB.clean(spark, SF001)
    live, gen = str(tmp_path / "live"), str(tmp_path / "gen=1")
    clean.write.partitionBy("event_date", "event_hour").parquet(live)
    compact_zone(spark, live, gen, closed_before="2024-01-15")
    whole = read_compacted(spark, live, gen).select(*clean.columns)
    assert whole.count() == clean.count() and whole.exceptAll(clean).count() == 0


def test_detect_dry_run_and_model_reuse(spark, tmp_path):
    clean = TB.clean(spark, SF001)
    mp = str(tmp_path / "model")
    assert detect(spark, clean, model_path=mp, window_hours=None, dry_run=True) is not None
    assert not os.path.exists(mp)
    ap = str(tmp_path / "alerts")
    a1 = detect(spark, clean, model_path=mp, window_hours=None, alerts_path=ap)
    n1 = spark.read.parquet(ap).count()
    assert os.path.exists(mp + "/nodes") and n1 == a1.select("alert_id").distinct().count()
    detect(spark, clean, model_path=mp, window_hours=None, alerts_path=ap)      # reuse model, re-run
    assert spark.read.parquet(ap).count() == n1
    empty = clean.filter(F.lit(False))
    assert detect(spark, empty, window_hours=None, dry_run=True) is None


# --- daily close & maintenance -------------------------------------------------------

def test_replace_day_idempotent_and_daily_close(spark, tmp_path):
    clean = TB.clean(spark, SF001)
    sp = str(tmp_path / "summary")
    D.replace_day(D.daily_summary(clean), sp)
    before = spark.read.parquet(sp).count()
    rep = daily_close(spark, clean, "2024-01-15", sp, model_path=str(tmp_path / "m"),
                      alerts_path=str(tmp_path / "alerts"))
    assert spark.read.parquet(sp).count() == before
    assert rep["cameras"] > 0 and rep["quality"]["total"] > 0
    with pytest.raises(ValueError):
        daily_close(spark, clean, "2030-01-01", sp, refit=False)
    raw = TB.raw(spark, SF001).withColumn("event_date", F.to_date("event_ts"))
    with pytest.raises(QualityGateFailed):
        daily_close(spark, raw.withColumn("vehicle_count", F.lit(None).cast("int")), "2024-01-15", sp,
                    refit=False)


def test_compaction_preserves_rows_and_vacuum_keeps_current(spark, tmp_path):
    clean = TB.clean(spark, SF001)
    src = str(tmp_path / "clean")
    clean.repartition(16).write.partitionBy("event_date").parquet(src)
    root = tmp_path / "gens"
    a = spark.read.parquet(src)

    def whole(*gens):
        z = M.read_compacted(spark, src, *gens).select(*a.columns)
        assert a.exceptAll(z).count() == 0 and z.exceptAll(a).count() == 0
        return len(M.zone_files(spark, src, gens))

    g1 = compact_zone(spark, src, str(root / "gen=1"))
    n_days = a.select("event_date").distinct().count()
    n_files = len(a.inputFiles())
    assert n_days <= whole(g1) < n_days * 2          # about one file per (small) day
    assert M.compacted_files(spark, g1) == n_files
    # an unchanged zone has nothing left to pack
    again = compact_zone(spark, src, str(root / "gen=1b"), generations=[g1])
    assert not os.path.exists(again) and whole(g1, again) == whole(g1)
    # a late file of a closed day is read, and packed with its day alone
    late = a.filter("event_date = '2024-01-05'").limit(3)
    late.write.mode("append").partitionBy("event_date").parquet(src)
    a = spark.read.parquet(src)
    whole(g1)
    g4 = compact_zone(spark, src, str(root / "gen=4"), generations=[g1])
    n_late = M.compacted_files(spark, g4)
    assert 2 <= n_late <= 5 and spark.read.parquet(g4).select("event_date").distinct().count() == 1
    whole(g1, g4)
    # a generation without its manifest is not part of the zone
    unfinished = str(root / "gen=5")
    a.write.partitionBy("event_date").parquet(unfinished)
    whole(g1, g4, unfinished)
    big = max(os.path.getsize(f.removeprefix("file://")) for f in a.inputFiles())
    g3 = compact_zone(spark, src, str(root / "gen=3"), target_mb=big * 2.5 / 2 ** 20)
    assert n_days < whole(g3) < n_files              # days of several bins
    g2 = compact_zone(spark, src, str(root / "gen=2"), closed_before="2024-01-10")
    assert spark.read.parquet(g2).agg(F.max("event_date")).first()[0] < dt.date(2024, 1, 10)
    whole(g2)
    far_future = int((dt.datetime.now() + dt.timedelta(days=30)).timestamp() * 1000)
    gone = vacuum_zone(spark, str(root), retain_hours=168, keep=[g2], now_ms=far_future)
    assert len(gone) == 4 and os.path.exists(g2)


def test_recent_events_top_n_matches_plain_sort(spark):
    clean = TB.clean(spark, SF001)
    now = TB.as_of(clean)
    for n in (1, 7, 50, 300, 5000):
        got = S.recent_events(clean, as_of=now, hours=24 * 40, n=n, max_buckets=16)
        ref = (clean.select(*got.columns).filter(F.col("event_ts") <= F.lit(now))
               .orderBy(F.col("event_ts").desc(), F.col("event_id").desc()).limit(n))
        assert got.count() == min(n, ref.count())
        assert got.exceptAll(ref).count() == 0


def test_zone_freshness_status(spark):
    from streetlake.streaming.health import zone_freshness
    now = dt.datetime(2024, 1, 1, 12, 0, 0)
    fresh = ev(spark, [row("1", ts=now - dt.timedelta(seconds=30))])
    lagging = ev(spark, [row("2", ts=now - dt.timedelta(seconds=300))])
    stale = ev(spark, [row("3", ts=now - dt.timedelta(hours=2))])
    empty = ev(spark, [row("4")]).filter(F.lit(False))
    out = {r.component: r for r in zone_freshness(
        {"a": fresh, "b": lagging, "c": stale, "d": empty}, as_of=now).collect()}
    assert (out["a"].status, out["b"].status, out["c"].status, out["d"].status) == \
        ("running", "degraded", "down", "down")
    assert out["a"].rows == 1 and out["d"].rows == 0


def test_hour_over_hour_gaps_and_zero(spark):
    rows = [row("1", ts=dt.datetime(2024, 1, 1, 8, 5), vc=10), row("2", ts=dt.datetime(2024, 1, 1, 9, 5), vc=0),
            row("3", ts=dt.datetime(2024, 1, 1, 10, 5), vc=5), row("4", ts=dt.datetime(2024, 1, 1, 12, 5), vc=5)]
    out = {r.hour_start.hour: r for r in S.hour_over_hour(ev(spark, rows)).collect()}
    assert out[8].prev_event_count is None and out[8].events_pct_change is None
    assert out[9].vehicles_pct_change == -100.0 and out[9].events_pct_change == 0.0
    assert out[10].vehicles_pct_change is None          # previous hour had 0 vehicles
    assert out[12].prev_event_count is None             # 11:00 had no events


def test_optional_filters_and_empty_summary(spark):
    clean = TB.clean(spark, SF001)
    day = clean.select("event_date").first()[0]
    prof = S.hourly_profile(clean, date=day, camera_id="CAM_03")
    assert prof.columns[0] == "event_hour"
    assert prof.agg(F.sum("event_count")).first()[0] == clean.filter(
        (F.col("event_date") == day) & (F.col("camera_id") == "CAM_03")).count()
    det = S.camera_detail(clean, camera_id="CAM_03", as_of=TB.as_of(clean), minutes=60 * 24 * 40)
    assert [r.camera_id for r in det.collect()] == ["CAM_03"]
    alerts = TB.alerts_table(spark, SF001)
    summary = S.platform_summary(clean, alerts, as_of=dt.datetime(2030, 1, 1)).first()
    assert (summary.total_events_today, summary.active_cameras, summary.total_cameras) == (0, 0, 12)
    assert (summary.avg_speed_kmh, summary.avg_congestion_score, summary.active_anomalies) == (0.0, 0.0, 0)
    crit = S.recent_alerts(alerts, severity="critical", limit=5).collect()
    assert all(r.severity == "CRITICAL" for r in crit) and len(crit) <= 5


def test_dq_stats_approximate_mode_close_to_exact(spark):
    raw = TB.raw(spark, SF001)
    exact = {r.event_date: r.dup_rate for r in Q.dq_stats(raw).collect()}
    approx = {r.event_date: r.dup_rate for r in Q.dq_stats(raw, exact=False).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(exact[k] - approx[k]) <= 0.05 for k in exact)


def test_means_keep_small_decimals(spark):
    from pyspark.sql import functions as F
    from streetlake.functions import exprs as X
    df = spark.createDataFrame([(4e-7,), (4e-7,), (-33.333,), (33.334,)], "x double")
    m = df.groupBy((F.abs("x") > 1).alias("k")).agg(X.mean_of("x").alias("m"))
    got = {x.k: x.m for x in m.collect()}
    assert got == {False: 4e-7, True: 0.0005}


@pytest.mark.parametrize("values", [
    [50.00001, 50.00002], [0.0], [1000.0, -1000.0, 999.999999999], [-0.000000001, 0.000000002, 0.1],
    [199.9, 0.1, 77.7, 77.7] * 500, [1e-9 * i for i in range(1000)], [-12.5, -12.5], [None, 3.25, None, 4.75], [None]])
def test_moments_are_exact(spark, values):
    """Count, sums and spread against rational arithmetic, whatever the partitioning."""
    from fractions import Fraction
    from math import sqrt
    from streetlake.functions import exprs as X
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    r = df.agg(X.moments_of("x").alias("m"), X.mean_of("x").alias("mean")) \
        .select("m.*", "mean", X.pop_std_from(F.col("m")).alias("std")).first()
    xs = [round(Fraction(v) * 10**9) for v in values if v is not None]
    assert (r.n, int(r.s or 0), int(r.q or 0)) == (len(xs), sum(xs), sum(x * x for x in xs))
    if not xs:
        assert r.mean is None and r.std is None
        return
    var = (Fraction(sum(x * x for x in xs)) - Fraction(sum(xs)) ** 2 / len(xs)) / len(xs) / 10**18
    assert abs(r.mean - sum(xs) / len(xs) / 1e9) < 1e-12
    assert abs(r.std - sqrt(var)) <= 1e-9 * max(1e-9, sqrt(var))


def test_integer_moments(spark):
    from streetlake.functions import exprs as X
    xs = [2**31 - 1, -2**31, 0, 7, 7, -1]
    df = spark.createDataFrame([(v,) for v in xs], "x int")
    r = df.agg(X.moments_of("x", True).alias("m")).select("m.*", X.pop_std_from(F.col("m"), True).alias("std")).first()
    assert (r.n, int(r.s), int(r.q)) == (6, sum(xs), sum(v * v for v in xs))
    mean = sum(xs) / 6
    assert abs(r.std - (sum((v - mean) ** 2 for v in xs) / 6) ** 0.5) < 1e-3


def test_bitmap_ids_count_like_text(spark):
    """Numbers, other spellings of them, text, negative and huge ids, nulls, repeated rows."""
    ids = ["1", "01", "1", "+1", " 1", "0", "-5", "32768", "32769", "32769", "9223372036854775807",
           "9223372036854775808", "abc", "abc", "", None, None, "7.0", "65537"]
    df = spark.createDataFrame([(i, "CAM_01", 5, 1.0, d) for i in ids for d in ("2024-01-15 01:00:00", None)],
                               "event_id string, camera_id string, vehicle_count int, average_speed double, t string") \
        .withColumn("event_ts", F.to_timestamp("t")).drop("t").repartition(4)
    for by_date in (True, False):
        want = sorted(map(tuple, Q.dq_stats(df, by_date=by_date).collect()), key=str)
        assert sorted(map(tuple, Q.dq_stats(df, by_date=by_date, bitmap=True).collect()), key=str) == want
    none = df.limit(0)
    assert Q.dq_stats(none, bitmap=True).count() == 0
    assert Q.dq_stats(none, by_date=False, bitmap=True).collect() == Q.dq_stats(none, by_date=False).collect()


def test_dedup_ties_are_broken_by_the_whole_row(spark):
    cols = "event_id string, kafka_partition int, kafka_offset long, kafka_ingest_ts timestamp, camera_id string"
    df = spark.createDataFrame([("a", None, None, None, f"c{i}") for i in range(50)], cols)
    assert {tuple(Q.dedup_events(df.repartition(n)).first()) for n in (1, 3, 8)} == {("a", None, None, None, "c0")}


def test_rows_without_event_id_are_not_merged(spark):
    from streetlake.operators import quality as Q
    cols = "event_id string, kafka_partition int, kafka_offset long, kafka_ingest_ts timestamp, camera_id string"
    rows = [(None, None, None, None, f"c{i}") for i in range(10)] + [("a", 0, 1, None, "x"), ("a", 0, 2, None, "x")]
    assert Q.dedup_events(spark.createDataFrame(rows, cols)).count() == 11


def test_compaction_keeps_null_partitions(spark, tmp_path):
    rows = [(None if i % 2 else "2024-01-01", f"c{i}", i) for i in range(10)]
    df = spark.createDataFrame(rows, "event_date string, camera_id string, event_ts int")
    src, gen = str(tmp_path / "z"), str(tmp_path / "gen=1")
    df.repartition(4).write.partitionBy("event_date").parquet(src)
    compact_zone(spark, src, gen)
    got = M.read_compacted(spark, src, gen)
    assert got.count() == 10 and got.filter("event_date IS NULL").count() == 5
    assert M.compacted_files(spark, gen) == len(spark.read.parquet(src).inputFiles())


def test_pack_small_files():
    files = [("a", f"a{i}", s) for i, s in enumerate([10, 90, 60, 50, 40, 30, 74, 76])] + [("b", "b0", 10)]
    bins = M.pack_small_files(files, 100)
    assert all(sum(f[2] for f in b) <= 100 and len(b) > 1 and len({f[0] for f in b}) == 1 for b in bins)
    packed = {f[1] for b in bins for f in b}
    assert "a1" not in packed and "a7" not in packed and "b0" not in packed     # large ones and a lone one
    assert M.pack_small_files([], 100) == []


def test_streaming_dedup_before_windows_sets_one_watermark(spark, tmp_path):
    from streetlake.streaming.pipeline import analytics_stream, clean_stream, raw_stream
    from streetlake.sources.streams import file_source
    (tmp_path / "in").mkdir()
    src = file_source(spark, str(tmp_path / "in"))
    q = analytics_stream(clean_stream(raw_stream(src), dedup=True)).writeStream.format("memory") \
        .queryName("dedup_windows").trigger(availableNow=True) \
        .option("checkpointLocation", str(tmp_path / "ck")).start()
    q.awaitTermination(60)
    assert q.exception() is None
