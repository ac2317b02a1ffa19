"""Registered queries (Spark) and their DuckDB oracle SQL.

Each entry is ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql or None)``.
All queries read the scale-factor folder's ``events`` table through the fixture
adapter; none runs on made-up input.  Columns are aliased identically on both
sides.  Processing-time columns (pipeline_ts, agg_ts, created_at of summaries)
are not part of registered outputs.  The queries live in ``queries_ingest``,
``queries_serving`` and ``queries_tables``; importing them fills the registry.
"""

from __future__ import annotations

from . import queries_ingest, queries_serving, queries_tables  # noqa: F401  (registration)
from .registry import REGISTRY, QueryFn


def queries() -> dict[str, QueryFn]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
