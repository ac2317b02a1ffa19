"""Command-line entry points (run in-process on the test session)."""

import json

from streetlake.__main__ import main
from streetlake.plans import tables as TB
from tests.conftest import SF001


def test_cli_detect_daily_close_and_query(spark, tmp_path, capsys):
    clean = str(tmp_path / "clean")
    TB.clean(spark, SF001).write.partitionBy("event_date", "event_hour").parquet(clean)
    args = ["detect", "--clean", clean, "--model", str(tmp_path / "m"), "--alerts", str(tmp_path / "a"),
            "--window-hours", "2000", "--as-of", "2024-01-31 00:00:00"]
    assert main(args, spark=spark) == 0
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert first["alerts"] > 0
    assert main(["detect", "--clean", clean, "--dry-run", "--window-hours", "1",
                 "--as-of", "2030-01-01 00:00:00"], spark=spark) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["alerts"] == 0
    rc = main(["daily-close", "--clean", clean, "--date", "2024-01-15", "--summary", str(tmp_path / "s"),
               "--no-refit"], spark=spark)
    assert rc == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["cameras"] > 0
    assert main(["query", "reject_stats", "--sf-dir", SF001, "--show", "3"], spark=spark) == 0
    assert len(capsys.readouterr().out.strip().splitlines()) == 3


def test_cli_endpoints(spark, tmp_path, capsys):
    clean = str(tmp_path / "clean")
    TB.clean(spark, SF001).write.partitionBy("event_date", "event_hour").parquet(clean)
    alerts = str(tmp_path / "alerts")
    TB.alerts_table(spark, SF001).drop("acknowledged", "acknowledged_at").write.parquet(alerts)
    now = "2024-01-30 23:30:00"
    for args in (["live", "--minutes", "1440"], ["summary"], ["cameras", "--minutes", "1440"],
                 ["camera", "--camera-id", "CAM_02", "--minutes", "1440"], ["alerts", "--severity", "warning"],
                 ["hourly", "--date", "2024-01-15"]):
        assert main(["endpoint", *args, "--clean", clean, "--alerts", alerts, "--as-of", now], spark=spark) == 0
        out = [json.loads(line) for line in capsys.readouterr().out.strip().splitlines()]
        assert out, args
        if args[0] == "alerts":
            assert all(r["severity"] == "WARNING" for r in out) and len(out) <= 50
        if args[0] == "camera":
            assert [r["camera_id"] for r in out] == ["CAM_02"]
