"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# Largest dimension/statistics frame that is ever broadcast (rows).
MAX_BROADCAST_ROWS = 200_000


def attach_small(big: DataFrame, small: DataFrame, on, how: str = "left",
                 max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join a derived, usually small frame (per-key statistics) onto ``big``.

    ``small`` is checkpointed once into the shared checkpoint folder (its
    lineage, a scan of the big input, is cut) and counted.  Within
    ``max_rows`` it is broadcast, so ``big`` is not shuffled; beyond it the
    plan falls back to a shuffled join that AQE may still re-plan.  Streaming
    frames are joined without the check.
    """
    if big.isStreaming or small.isStreaming:
        return big.join(small, on, how)
    return join_counted(big, cut_lineage(small), on, how, max_rows)


def join_counted(big: DataFrame, small: DataFrame, on, how: str = "left",
                 max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join an already materialised (checkpointed) ``small``: count it (cheap,
    it is read back from the checkpoint) and broadcast only within
    ``max_rows``; otherwise a shuffled join, with the broadcast hint withheld."""
    if small.count() <= max_rows:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin split an input that arrives in fewer partitions than the
    cluster has cores (e.g. one small unsplittable file) before CPU-heavy
    Python work.  Inputs that already have enough partitions -- any large
    table -- are returned unchanged, so no shuffle is added at scale."""
    if df.isStreaming:
        return df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)
