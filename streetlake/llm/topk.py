"""Exact top-k search with Fagin's threshold algorithm.

Vectors are cut into blocks; a cell is one block of queries against one block
of candidates.  In a cell every dimension has a list sorted by its component.
For a query the lists are read from their better end, a band of entries at a
time; every vector met is scored in full, and reading stops once the sum of
the components last read, times the query's, is under the k-th score, as nothing
unread can reach it then, or once every vector has been met.  The cells' results are merged by a ranking window.

Blocks hold a bounded number of components, so wide vectors give smaller ones.
A candidate is shuffled once per block of queries, a query once per block of
candidates; rows are numbered and dealt to blocks by their number, so that an
id on many rows is spread like any other.

Defined results: vectors that are null, or hold a null or non-finite
component, take no part (neither do rows without an id); vectors are compared
with those of their own length only; a query is a row, and finds every row but
itself: rows of one id, equal or not, are queries with a list each, and find each
other; ties go to the smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streetlake.llm.common import ship_package, stage

CANDIDATES, QUERIES = 16_384, 4_096    # most rows of a block
NUMBERS = 1 << 22                      # components of a block
FEW_QUERIES = 512                      # blocks of queries aren't made smaller than this for more tasks
BAND = 32                              # entries read from each list at first


def threshold_top(query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, order: np.ndarray, k: int,
                  own: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best rows of ``vectors`` for ``query``.

    ``order[d]`` holds the rows in ascending order of component d; ``own`` is
    the query's own row among them, or -1.
    """
    n = len(vectors)
    others = np.ones(n, bool)
    if own >= 0:
        others[own] = False
    ups = np.flatnonzero(query > 0)
    downs = np.flatnonzero(query < 0)
    seen = np.zeros(n, bool)
    scores = np.full(n, np.iinfo(np.int64).min, np.int64)
    depth, band = 0, BAND
    while True:
        end = min(n, depth + band)
        if len(ups) or len(downs):
            met = np.concatenate([order[ups, n - end:n - depth].ravel(), order[downs, depth:end].ravel()])
        else:
            met = np.arange(n)          # a zero query: every score is 0
            end = n
        fresh = np.zeros(n, bool)
        fresh[met] = True
        fresh &= ~seen
        rows = np.flatnonzero(fresh)
        seen |= fresh
        scores[rows] = vectors[rows] @ query
        depth, band = end, band * 2
        done = depth >= n or bool(seen.all())       # every row met: nothing is left to read
        if not done:
            have = scores[seen & others]
            if len(have) >= k:
                least = np.partition(have, len(have) - k)[len(have) - k]
                bound = int(vectors[order[ups, n - depth], ups] @ query[ups]) \
                    + int(vectors[order[downs, depth - 1], downs] @ query[downs])
                done = bound < least
        if done:
            rows = np.flatnonzero(seen & others)
            best = rows[np.lexsort((ids[rows], -scores[rows]))[:k]]
            return ids[best], scores[best]


def _array(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return table.column("row").to_numpy(), ids, flat.reshape(len(ids), -1) if len(ids) else np.zeros((0, 0), np.int64)


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id and floor(256 * x) of the vectors that take part."""
    v = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("e"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    v = v.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & finite & (F.size("e") > 0))
    return v.select("vec_id", F.transform("e", lambda x: F.floor(x * 256).cast("long")).alias("v"))


def exact_top_k(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The k highest inner products of every row whose id ``every`` divides."""
    ship_package(embeddings.sparkSession)
    v = stage(quantised(embeddings).withColumn("row", F.monotonically_increasing_id()), "vectors")
    v = v.withColumn("d", F.size("v"))
    isq = F.col("vec_id") % every == 0
    size = v.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(isq, 1)).alias("q"), F.avg("d").alias("d")).first()
    at_most = lambda rows: max(1, min(rows, int(NUMBERS / (size["d"] or 1))))
    blocks = max(1, -(-size["n"] // at_most(CANDIDATES)))
    tasks = 2 * embeddings.sparkSession.sparkContext.defaultParallelism
    groups = max(1, -(-size["q"] // at_most(QUERIES)), min(-(-size["q"] // FEW_QUERIES), -(-tasks // blocks)))
    place = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    every_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cands = v.select("row", "vec_id", "v", "d", place(blocks, "c").alias("c"), every_of(groups).alias("q"))
    queries = v.where(isq).select("row", "vec_id", "v", "d", every_of(blocks).alias("c"), place(groups, "q").alias("q"))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        qrow, qid, qv = _array(left)
        crow, cid, cv = _array(right)
        out: list[tuple[np.ndarray, ...]] = []
        if len(qid) and len(cid):
            order = np.argsort(cv, axis=0, kind="stable").T
            at = {row: i for i, row in enumerate(crow.tolist())}
            for row, own, query in zip(qrow.tolist(), qid, qv):
                ids, scores = threshold_top(query, cv, cid, order, k, at.get(row, -1))
                out.append((np.full(len(ids), row), np.full(len(ids), own), ids, scores))
        a, b, c, s = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4
        return pa.table({"row": a, "query_id": b, "vec_id": c, "score": s})

    found = queries.groupBy("c", "q", "d").cogroup(cands.groupBy("c", "q", "d")) \
        .applyInArrow(cell, "row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
