"""Daily close (U6): DQ gate -> summary + model refit + compaction -> report.

A plain function any scheduler can call for day ``d``.  Every write is
idempotent: the summary replaces its day partition, alerts are inserted only
if absent, compaction writes a new generation.  With a step log, a close that
failed resumes after its last finished step.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.daily import daily_report, daily_summary, replace_day
from ..operators.quality import dq_gate, dq_stats
from .detect import clean_day, detect
from .maintenance import compact_zone, vacuum_zone


class QualityGateFailed(RuntimeError):
    def __init__(self, stats: dict):
        super().__init__(f"Quality gate failed: {stats}")
        self.stats = stats


STEPS = "close_date string, step string, detail string, finished_at timestamp"


class StepLog:
    """Finished steps of a day's close, one row each, in a table at ``path`` (None: kept nowhere)."""

    def __init__(self, spark: SparkSession, path: str | None, date):
        self.spark, self.path, self.date = spark, path, str(date)
        self.done: dict[str, str] = {}
        if path:
            try:
                rows = spark.read.schema(STEPS).parquet(path).filter(F.col("close_date") == self.date).collect()
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                rows = []
            self.done = {r["step"]: r["detail"] for r in rows}

    def run(self, step: str, work):
        """``work()`` unless the step is done; its JSON result is kept with the step."""
        if step in self.done:
            return json.loads(self.done[step])
        detail = json.dumps(work(), default=str)
        if self.path:
            self.spark.createDataFrame([(self.date, step, detail)], "close_date string, step string, detail string") \
                .withColumn("finished_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path)
        return json.loads(detail)


def daily_close(spark: SparkSession, clean: DataFrame, date, summary_path: str,
                model_path: str | None = None, alerts_path: str | None = None,
                compact: dict | None = None, max_bad: float = 0.05, refit: bool = True,
                vacuum: dict | None = None, retain_hours: float = 168, steps_path: str | None = None) -> dict:
    """Run the daily close for ``date`` and return the report row as a dict.

    ``compact`` maps a source zone path to its new generation path;
    ``vacuum`` maps a generation root to the generations to keep, and drops
    the others older than ``retain_hours`` (7 days by default).
    ``steps_path`` names the step log: a second run of the same day skips the
    steps that finished before (a close that was done returns its report).
    Raises ``ValueError`` when the day has no rows and ``QualityGateFailed``
    when the DQ gate fails (with the statistics attached); neither is recorded
    as finished.
    """
    log = StepLog(spark, steps_path, date)
    day = clean_day(clean, date)
    after = dt.date.fromisoformat(str(date)) + dt.timedelta(days=1)

    def gate() -> dict:
        row = dq_gate(dq_stats(day, by_date=False), max_bad=max_bad).first()
        if row is None or row["total"] == 0:
            raise ValueError(f"No data found for {date} - pipeline may be down.")
        if row["decision"] != "quality_pass":
            raise QualityGateFailed(row.asDict())
        return {k: row[k] for k in ("total", "null_rate", "out_of_range", "dup_rate")}

    def summary() -> None:
        replace_day(daily_summary(day).withColumn("created_at", F.current_timestamp()), summary_path)

    def refit_and_detect() -> None:
        detect(spark, clean, model_path=model_path, window_hours=48, retrain=True,
               as_of=dt.datetime.combine(after, dt.time()), alerts_path=alerts_path)

    quality = log.run("gate", gate)
    log.run("summary", summary)
    if refit:
        log.run("refit", refit_and_detect)
    for src, dst in (compact or {}).items():
        log.run(f"compact {src}", lambda src=src, dst=dst: compact_zone(spark, src, dst, closed_before=after))
    removed = []
    for root, keep in (vacuum or {}).items():
        removed += log.run(f"vacuum {root}", lambda root=root, keep=keep: vacuum_zone(spark, root, retain_hours, keep=keep))

    def report() -> dict:
        row = daily_report(spark.read.parquet(summary_path), date).first()
        return row.asDict() if row is not None else {"date": date}

    out = log.run("report", report)
    return {**out, "quality": quality, "vacuumed": removed}
