"""Command line: ``python -m streetlake <command> ...`` (or via spark-submit).

stream       run the raw / clean / analytics streaming queries
detect       score the clean zone and append alerts (window, threshold, retrain, dry run)
score        score a clean zone's new rows as a stream
daily-close  DQ gate -> daily summary -> refit -> compaction -> report (JSON)
compact      pack small files of closed partitions of a zone into a new generation
vacuum       drop old, non-current zone generations
ack          acknowledge stored alerts by id
endpoint     the operational API's queries over stored zones (live, summary, ...)
query        run a registered query over a scale-factor folder and print rows
"""

from __future__ import annotations

import argparse
import json
import sys


def _session(args):
    from .session import build_session, ship_package
    spark = build_session(args.master, app=f"streetlake-{args.command}",
                          profile="cluster" if args.cluster else None)
    ship_package(spark)
    return spark


def cmd_stream(spark, a):
    from .sources.streams import file_source, kafka_source
    from .streaming.pipeline import await_all, run_chained, run_pipeline
    if a.source == "kafka":
        src = lambda: kafka_source(spark, a.servers, a.topic, a.starting, a.max_offsets)
    else:
        src = lambda: file_source(spark, a.path, a.max_files)
    if a.health and not a.available_now:
        from .streaming.health import HealthListener
        spark.streams.addListener(HealthListener(spark, a.health))
    runner = run_chained if a.chained else run_pipeline
    queries = runner(spark, src, a.base, available_now=a.available_now, dedup=a.dedup,
                     quarantine=a.quarantine)
    if a.available_now:
        await_all(queries)
        if a.health:
            from .streaming.health import write_health
            write_health(spark, queries, a.health)
    else:
        spark.streams.awaitAnyTermination()
    return 0


def cmd_detect(spark, a):
    from .plans.detect import detect
    from .sources.streams import read_zone
    alerts = detect(spark, read_zone(spark, a.clean), model_path=a.model, window_hours=a.window_hours,
                    threshold=a.threshold, retrain=a.retrain, dry_run=a.dry_run, as_of=a.as_of,
                    norm=a.norm, alerts_path=a.alerts, publish_servers=a.publish,
                    spike_pct=a.spike_pct, min_speed=a.min_speed)
    n = 0 if alerts is None else alerts.count()
    print(json.dumps({"alerts": n, "dry_run": a.dry_run}))
    return 0


def cmd_score(spark, a):
    """Score the clean zone's new rows as they arrive."""
    from .operators.alerts import baselines
    from .operators.iforest import ForestModel
    from .sources.streams import read_zone, read_zone_stream
    from .streaming.pipeline import RunningBaselines, await_all, score_stream
    model = ForestModel.load(spark, a.model)
    if model is None:
        print(json.dumps({"error": f"no model at {a.model}"}))
        return 3
    clean = read_zone(spark, a.clean)
    running = RunningBaselines(spark, a.running_baselines) if a.running_baselines else None
    query = score_stream(read_zone_stream(spark, a.clean, clean.schema), model, a.alerts, a.checkpoint,
                         None if running else baselines(clean), threshold=a.threshold,
                         available_now=a.available_now, publish_servers=a.publish,
                         spike_pct=a.spike_pct, min_speed=a.min_speed, running=running)
    await_all([query])
    return 0


def cmd_daily_close(spark, a):
    from .plans.daily_close import QualityGateFailed, daily_close
    from .sources.streams import read_zone
    compact = dict(kv.split("=", 1) for kv in (a.compact or []))
    vacuum = {root: keep.split(",") if keep else [] for root, _, keep in
              (kv.partition("=") for kv in (a.vacuum or []))}
    try:
        report = daily_close(spark, read_zone(spark, a.clean), a.date, a.summary, model_path=a.model,
                             alerts_path=a.alerts, compact=compact, refit=not a.no_refit,
                             vacuum=vacuum, retain_hours=a.retain_hours, steps_path=a.steps)
    except QualityGateFailed as e:
        print(json.dumps({"quality": "fail", "stats": e.stats}, default=str))
        return 2
    print(json.dumps(report, default=str))
    return 0


def cmd_compact(spark, a):
    from .plans.maintenance import compact_zone
    from .plans.maintenance import compacted_files
    dst = compact_zone(spark, a.src, a.dst, closed_before=a.closed_before, target_mb=a.target_mb,
                       generations=a.generations or ())
    print(json.dumps({"generation": dst, "files_replaced": compacted_files(spark, dst)}))
    return 0


def cmd_vacuum(spark, a):
    from .plans.maintenance import vacuum_zone
    print(json.dumps(vacuum_zone(spark, a.root, a.retain_hours, keep=a.keep or [])))
    return 0


def cmd_endpoint(spark, a):
    """The operational API's endpoints as queries over stored zones."""
    from .operators import serving as S
    from .operators.alerts import alerts_with_ack
    from .sources.streams import read_zone
    from .streaming.health import zone_freshness
    from pyspark.sql import functions as F
    clean = read_zone(spark, a.clean) if a.clean else None

    def alerts():
        t = spark.read.parquet(a.alerts)
        if a.acks:
            t = alerts_with_ack(t, spark.read.parquet(a.acks))
        elif "acknowledged_at" not in t.columns:
            t = t.withColumn("acknowledged_at", F.lit(None).cast("timestamp"))
        return t

    name = a.name
    if name == "live":
        df = S.live_metrics(clean, as_of=a.as_of, minutes=a.minutes, camera_id=a.camera_id)
    elif name == "summary":
        df = S.platform_summary(clean, alerts(), as_of=a.as_of)
    elif name == "cameras":
        df = S.cameras_status(clean, as_of=a.as_of, minutes=a.minutes)
    elif name == "camera":
        df = S.camera_detail(clean, as_of=a.as_of, camera_id=a.camera_id, minutes=a.minutes)
    elif name == "alerts":
        from .operators.alerts import newest_stored_alerts
        newest = newest_stored_alerts(spark, a.alerts, severity=a.severity, limit=a.limit)
        if a.acks:
            newest = alerts_with_ack(newest, spark.read.parquet(a.acks))
        df = S.recent_alerts(newest, limit=a.limit)
    elif name == "hourly":
        df = S.hourly_profile(clean, date=a.date, camera_id=a.camera_id)
    elif name == "health":
        zones = {z: read_zone(spark, f"{a.base}/{z}") for z in ("raw", "clean")}
        zones["analytics"] = read_zone(spark, f"{a.base}/analytics").withColumnRenamed("window_end", "event_ts")
        df = zone_freshness(zones, as_of=a.as_of)
    else:
        raise SystemExit(f"unknown endpoint {name}")
    for row in df.toLocalIterator():
        print(json.dumps(row.asDict(), default=str))
    return 0


def cmd_ack(spark, a):
    """Acknowledge stored alerts; ids that name none are reported (exit code 4)."""
    from .operators.alerts import store_acks
    unknown = store_acks(spark, a.alerts, a.acks, a.id, a.at)
    print(json.dumps({"acknowledged": len(set(a.id)) - len(unknown), "unknown": unknown}))
    return 4 if unknown else 0


def cmd_query(spark, a):
    from .plans.catalog import queries
    df = queries()[a.name](spark, a.sf_dir)
    for row in df.limit(a.show).collect():
        print(json.dumps(row.asDict(), default=str))
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m streetlake", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    p.add_argument("--cluster", action="store_true", help="apply the cluster session profile")
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("stream")
    s.add_argument("--source", choices=["kafka", "files"], default="kafka")
    s.add_argument("--servers", default="localhost:9092")
    s.add_argument("--topic", default="traffic.raw.events")
    s.add_argument("--starting", default="latest")
    s.add_argument("--max-offsets", type=int, default=5000)
    s.add_argument("--path", help="replay folder for --source files")
    s.add_argument("--max-files", type=int, default=1)
    s.add_argument("--base", required=True, help="zone base folder (raw/, clean/, analytics/, _checkpoints/)")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--chained", action="store_true", help="read the broker once (raw -> clean -> analytics)")
    s.add_argument("--dedup", action="store_true")
    s.add_argument("--health", help="health-log table: a row per progress report of a running "
                   "stream, one per query after an --available-now run")
    s.add_argument("--quarantine", action="store_true", help="keep rows that break the contract, count rejects")

    d = sub.add_parser("detect")
    d.add_argument("--clean", required=True)
    d.add_argument("--model")
    d.add_argument("--alerts")
    d.add_argument("--window-hours", type=float, default=48)
    d.add_argument("--threshold", type=float, default=0.85)
    d.add_argument("--retrain", action="store_true")
    d.add_argument("--dry-run", action="store_true")
    d.add_argument("--as-of")
    d.add_argument("--norm", choices=["batch", "model"], default="batch")
    d.add_argument("--publish", help="Kafka servers: also send new alerts to the alert topics")

    t = sub.add_parser("score", help="score a clean zone's new rows as a stream")
    t.add_argument("--clean", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--alerts", required=True)
    t.add_argument("--checkpoint", required=True)
    t.add_argument("--running-baselines", metavar="PATH",
                   help="keep running means per camera here, over all rows scored so far")
    t.add_argument("--threshold", type=float, default=0.85)
    t.add_argument("--available-now", action="store_true")
    t.add_argument("--publish", help="Kafka servers: also send new alerts to the alert topics")
    for x in (d, t):
        x.add_argument("--spike-pct", type=float, default=200.0)
        x.add_argument("--min-speed", type=float, default=10.0)

    k = sub.add_parser("ack")
    k.add_argument("--alerts", required=True)
    k.add_argument("--acks", required=True, help="ack log folder")
    k.add_argument("--id", nargs="+", required=True)
    k.add_argument("--at", help="time of the acknowledgement (default: now)")

    c = sub.add_parser("daily-close")
    c.add_argument("--clean", required=True)
    c.add_argument("--date", required=True)
    c.add_argument("--summary", required=True)
    c.add_argument("--model")
    c.add_argument("--alerts")
    c.add_argument("--compact", nargs="*", help="SRC=DST zone generation pairs")
    c.add_argument("--no-refit", action="store_true")
    c.add_argument("--vacuum", nargs="*", help="ROOT=KEEP1,KEEP2 generation roots to clean up")
    c.add_argument("--retain-hours", type=float, default=168)
    c.add_argument("--steps", help="step log: a failed close resumes after its last finished step")

    k = sub.add_parser("compact")
    k.add_argument("--src", required=True)
    k.add_argument("--dst", required=True)
    k.add_argument("--closed-before")
    k.add_argument("--target-mb", type=float, default=128)
    k.add_argument("--generations", nargs="*", help="generations made before, oldest first")

    v = sub.add_parser("vacuum")
    v.add_argument("--root", required=True)
    v.add_argument("--retain-hours", type=float, default=168)
    v.add_argument("--keep", nargs="*")

    e = sub.add_parser("endpoint", help="live | summary | cameras | camera | alerts | hourly | health")
    e.add_argument("name", choices=["live", "summary", "cameras", "camera", "alerts", "hourly", "health"])
    e.add_argument("--clean")
    e.add_argument("--alerts")
    e.add_argument("--acks", help="ack log (alert_id, acked_at) joined onto the alerts")
    e.add_argument("--base", help="zone base folder (health)")
    e.add_argument("--as-of")
    e.add_argument("--minutes", type=float, default=5)
    e.add_argument("--camera-id")
    e.add_argument("--severity")
    e.add_argument("--date")
    e.add_argument("--limit", type=int, default=50)

    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    q.add_argument("--show", type=int, default=20)
    return p


COMMANDS = {"stream": cmd_stream, "detect": cmd_detect, "score": cmd_score, "daily-close": cmd_daily_close,
            "compact": cmd_compact, "vacuum": cmd_vacuum, "ack": cmd_ack, "endpoint": cmd_endpoint, "query": cmd_query}


def main(argv=None, spark=None) -> int:
    args = parser().parse_args(argv)
    spark = spark or _session(args)
    return COMMANDS[args.command](spark, args)


if __name__ == "__main__":
    sys.exit(main())
