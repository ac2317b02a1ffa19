"""Distributed isolation forest.

Fit
  1. one aggregation gives n and the exact feature sums (scaler, A7);
  2. a hash threshold keeps a pool of about ``pool_factor * trees * psi`` rows,
     so the remaining cost does not grow with n; identical rows become one row
     with a count, so that a row repeated any number of times is never gathered;
  3. tree ids are exploded over the pool and a second hash keeps ~2*psi rows
     per tree (checked; widened until every tree has psi rows);
  4. ``groupBy("tree").applyInPandas`` builds one tree per group from the psi
     rows with the smallest hash, RNG seeded by (seed, tree).
  Every step is deterministic under any partitioning.  Hashes cover the ids and
  all features: rows without an event id are sampled like others.

Score
  The node table is bounded by ``trees * (2 psi - 1)`` rows, independent of the
  data, and is broadcast; ``mapInArrow`` walks all trees for an Arrow batch at
  once with NumPy (other columns pass through untouched).  s = -2^(-E[h]/c(psi)); anomaly_score flips a min-max scaling
  whose min/max come from the scored batch (``norm="batch"``) or from the fit
  (``norm="model"``, needed for streaming).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..schema import FEATURE_COLS, INTEGRAL_FEATURES
from ..session import cut_lineage, stored
from .joins import spread

N_TREES = 200
PSI = 256
SEED = 42
POOL_FACTOR = 8
OVERSAMPLE = 2.0
EULER_GAMMA = 0.5772156649015329
# what tells rows apart, besides their features
ID_COLS = ["event_id", "kafka_partition", "kafka_offset", "camera_id", "event_ts"]

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()),
    T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()),
    T.StructField("path", T.DoubleType()),
    T.StructField("size", T.IntegerType()),
])


def c_factor(m) -> np.ndarray:
    """Average path length of an unsuccessful BST search over m points."""
    m = np.asarray(m, dtype=float)
    out = np.zeros_like(m)
    out = np.where(m == 2, 1.0, out)
    big = m > 2
    mb = np.where(big, m, 3.0)
    out = np.where(big, 2.0 * (np.log(mb - 1.0) + EULER_GAMMA) - 2.0 * (mb - 1.0) / mb, out)
    return out


def _unit_hash(*cols) -> "F.Column":
    """Deterministic uniform value in [0, 1) from a 64-bit hash."""
    h = F.xxhash64(*cols)
    return (F.pmod(h, F.lit(1 << 52)).cast("double")) / float(1 << 52)


# --- scaler (A7) -----------------------------------------------------------------

def fit_scaler(df: DataFrame, features=FEATURE_COLS) -> DataFrame:
    """Mean and population std per feature (exact sums; zero std -> 1)."""
    integral = {f: f in INTEGRAL_FEATURES for f in features}
    wide = df.agg(*[X.moments_of(f, integral[f]).alias(f"{f}__m") for f in features],
                  *[X.mean_of(f, integral[f]).alias(f"{f}__mean") for f in features])
    rows = [F.struct(F.lit(f).alias("feature"), F.lit(integral[f]).alias("integral"), F.col(f"{f}__m").alias("m"),
                     F.col(f"{f}__mean").alias("mean")) for f in features]
    long = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    std = X.pop_std_from(F.col("m"), F.col("integral"))         # one expression for all features
    return long.select("feature", F.col("m.n").alias("n"), "mean", F.when(std > 0, std).otherwise(F.lit(1.0)).alias("std"))


def scale(df: DataFrame, stats: dict, features=FEATURE_COLS, prefix: str = "z_") -> DataFrame:
    """Standardise features with driver-side constants (6 means, 6 stds)."""
    cols = [((F.col(f).cast("double") - F.lit(stats[f][0])) / F.lit(stats[f][1])).alias(prefix + f)
            for f in features]
    return df.select("*", *cols)


# --- model ---------------------------------------------------------------------

@dataclass
class ForestModel:
    nodes: pd.DataFrame
    features: list
    scaler: dict            # feature -> (mean, std)
    psi: int
    n_trees: int
    seed: int = SEED
    score_min: float | None = None
    score_max: float | None = None

    # K7 ------------------------------------------------------------------------
    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path + "/nodes")
        meta = [(f, float(m), float(s)) for f, (m, s) in self.scaler.items()]
        info = spark.createDataFrame(
            [(self.psi, self.n_trees, self.seed, self.score_min, self.score_max, ",".join(self.features))],
            "psi int, n_trees int, seed int, score_min double, score_max double, features string")
        spark.createDataFrame(meta, "feature string, mean double, std double").coalesce(1) \
            .write.mode("overwrite").parquet(path + "/scaler")
        info.coalesce(1).write.mode("overwrite").parquet(path + "/info")

    @classmethod
    def load(cls, spark: SparkSession, path: str | None):
        if not path:
            return None
        try:
            info = spark.read.parquet(path + "/info").first()
            nodes = spark.read.parquet(path + "/nodes").toPandas()
            sc = {r.feature: (r.mean, r.std) for r in spark.read.parquet(path + "/scaler").collect()}
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None                   # no model saved yet -> fit one
        feats = info.features.split(",")
        return cls(nodes=nodes, features=feats, scaler=sc, psi=info.psi, n_trees=info.n_trees,
                   seed=info.seed, score_min=info.score_min, score_max=info.score_max)

    # arrays for traversal ---------------------------------------------------------
    def arrays(self):
        """Trees re-laid as complete binary trees of depth D (heap order).

        Internal slots hold (feature, threshold); a leaf above depth D becomes a
        pass-through chain (threshold +inf, always left) ending in its path
        length at the bottom level, so traversal is exactly D steps of
        ``idx = 2*idx + 1 + (x > t)`` with no branching.
        """
        depth = max(1, int(math.ceil(math.log2(max(self.psi, 2)))))
        n_int, n_leaf = (1 << depth) - 1, 1 << depth
        feat = np.zeros((self.n_trees, n_int), dtype=np.int64)
        thr = np.full((self.n_trees, n_int), np.inf)
        leaf = np.zeros((self.n_trees, n_leaf))
        for t, g in self.nodes.groupby("tree"):
            rec = {int(r.node): r for r in g.itertuples(index=False)}
            stack = [(0, 0)]                       # (node id, heap slot)
            while stack:
                nid, h = stack.pop()
                r = rec[nid]
                if r.feature >= 0:
                    feat[t, h], thr[t, h] = int(r.feature), float(r.threshold)
                    stack += [(int(r.left), 2 * h + 1), (int(r.right), 2 * h + 2)]
                    continue
                while h < n_int:                   # pass-through to the bottom level
                    h = 2 * h + 1
                leaf[t, h - n_int] = float(r.path)
        return dict(feat=feat.ravel(), thr=thr.ravel(), leaf=leaf.ravel(), depth=depth,
                    n_int=n_int, n_leaf=n_leaf, n_trees=self.n_trees, c=float(c_factor(self.psi)))


# --- tree building (runs inside applyInPandas, one group = one tree) ----------------

def _build_tree(tree: int, X: np.ndarray, psi: int, seed: int) -> list:
    rng = np.random.default_rng([seed, tree])
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    rows = []                        # [node, feature, threshold, left, right, path, size]
    stack = [(0, np.arange(len(X)), 0)]
    next_id = 1
    out = {}
    while stack:
        nid, idx, depth = stack.pop()
        n = len(idx)
        if depth >= max_depth or n <= 1:
            out[nid] = [nid, -1, None, None, None, depth + float(c_factor(n)), n]
            continue
        xs = X[idx]
        lo, hi = xs.min(axis=0), xs.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if cand.size == 0:
            out[nid] = [nid, -1, None, None, None, depth + float(c_factor(n)), n]
            continue
        f = int(cand[rng.integers(cand.size)])
        t = float(rng.uniform(lo[f], hi[f]))
        go_left = xs[:, f] <= t
        lid, rid = next_id, next_id + 1
        next_id += 2
        out[nid] = [nid, f, t, lid, rid, None, n]
        stack.append((rid, idx[~go_left], depth + 1))
        stack.append((lid, idx[go_left], depth + 1))
    for nid in sorted(out):
        rows.append([tree] + out[nid])
    return rows


def _builder(features, psi, seed):
    zcols = ["z_" + f for f in features]

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(["h", *zcols], kind="mergesort")
        pdf = pdf.loc[pdf.index.repeat(pdf["copies"])].head(psi)
        rows = _build_tree(tree, pdf[zcols].to_numpy(dtype=float), psi, seed)
        out = pd.DataFrame(rows, columns=[f.name for f in NODE_SCHEMA.fields])
        return out.astype({"tree": "int32", "node": "int32", "feature": "int32", "threshold": "float64",
                           "left": "Int32", "right": "Int32", "path": "float64", "size": "int32"})
    return build


def fit_forest(df: DataFrame, n_trees: int = N_TREES, psi: int = PSI, seed: int = SEED,
               features=FEATURE_COLS, pool_factor: int = POOL_FACTOR,
               calibrate: bool = False) -> ForestModel | None:
    """Fit on feature-complete rows of ``df`` (None without such rows).

    ``calibrate`` also scores all training rows once to store the min/max that
    ``norm="model"`` (streaming) scales by; batch scoring does not need it.
    """
    data = df.dropna(subset=list(features))
    stats_rows = fit_scaler(data, features).collect()           # one row per feature
    n = int(stats_rows[0]["n"]) if stats_rows else 0
    if n == 0:
        return None
    scaler = {r["feature"]: (float(r["mean"]), float(r["std"])) for r in stats_rows}
    psi_eff = min(psi, n)
    pool_frac = min(1.0, pool_factor * n_trees * psi / n)
    ids = [c for c in ID_COLS if c in data.columns]
    keyed = data.select(*features, F.xxhash64(*ids, *features, F.lit(seed)).alias("key"))
    pool = keyed if pool_frac >= 1.0 else keyed.filter(_unit_hash("key", F.lit(seed)) < pool_frac)
    # about pool_factor * trees * psi rows at any n; a tree takes at most psi
    # copies of a row, so more need not be counted
    pool = pool.groupBy("key", *features).agg(
        F.least(F.count(F.lit(1)), F.lit(psi_eff)).cast("int").alias("copies"))
    spark = df.sparkSession
    pool = cut_lineage(scale(pool, scaler, features).repartition(spark.sparkContext.defaultParallelism))
    m = max(1.0, n * pool_frac)
    q = min(1.0, OVERSAMPLE * psi_eff / m)
    zcols = ["z_" + f for f in features]
    trees = F.sequence(F.lit(0), F.lit(n_trees - 1))
    pairs = pool.select("copies", *zcols, "key", F.explode(trees).alias("tree"))
    pairs = pairs.withColumn("h", _unit_hash("key", F.col("tree"), F.lit(seed))).drop("key")
    while True:
        # bounded (~2 psi rows per tree): checkpointed so the size check and
        # the tree build neither recompute nor depend on the scan behind it
        sample = cut_lineage(pairs.filter(F.col("h") < q) if q < 1.0 else pairs)
        # every tree must see at least psi rows; otherwise widen the sample
        full = sample.groupBy("tree").agg(F.sum("copies").alias("n")).filter(F.col("n") >= psi_eff).count()
        if full == n_trees:
            break
        if q >= 1.0:
            raise ValueError(f"the pool holds fewer than {psi_eff} rows; fit with a larger pool_factor")
        q = min(1.0, q * 2)
    nodes = (sample.groupBy("tree")
             .applyInPandas(_builder(features, psi_eff, seed), NODE_SCHEMA)
             .toPandas())
    model = ForestModel(nodes=nodes, features=list(features), scaler=scaler, psi=psi_eff,
                        n_trees=n_trees, seed=seed)
    if calibrate:
        calibrate_model(model, spread(data.select(*features)))
    return model


def calibrate_model(model: ForestModel, df: DataFrame) -> ForestModel:
    """Store min/max of ``df``'s raw scores in the model (for norm="model").

    ``df`` holds the training rows, scored already or not."""
    raw = df if "anomaly_raw" in df.columns else score_raw(df, model)
    mm = raw.agg(F.min("anomaly_raw").alias("lo"), F.max("anomaly_raw").alias("hi")).first()
    model.score_min, model.score_max = float(mm["lo"]), float(mm["hi"])
    return model


# --- scoring (U2) -----------------------------------------------------------------------

def _scorer(bc, features, zmeans, zstds):
    def score(batches):
        a = bc.value
        feat, thr, leaf = a["feat"], a["thr"], a["leaf"]
        n_trees, n_int, n_leaf = a["n_trees"], a["n_int"], a["n_leaf"]
        int_off = (np.arange(n_trees) * n_int)[None, :]
        leaf_off = (np.arange(n_trees) * n_leaf)[None, :]
        for b in batches:
            if not b.num_rows:
                continue
            x = np.column_stack([b.column(f).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in features])
            x = (x - zmeans) / zstds
            rows = np.arange(x.shape[0])[:, None]
            idx = np.zeros((x.shape[0], n_trees), dtype=np.int64)
            for _ in range(a["depth"]):
                flat = idx + int_off
                idx = 2 * idx + 1 + (x[rows, feat[flat]] > thr[flat])
            eh = leaf[idx - n_int + leaf_off].mean(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(-np.power(2.0, -eh / a["c"]))],
                                             names=[*b.schema.names, "anomaly_raw"])
    return score


def share_model(spark: SparkSession, model: ForestModel):
    """The model's arrays as a broadcast (``trees * 2 psi`` entries), for
    callers that score many frames with one model."""
    return spark.sparkContext.broadcast(model.arrays())


def score_raw(df: DataFrame, model: ForestModel, spark: SparkSession | None = None, shared=None) -> DataFrame:
    """Add ``anomaly_raw`` (sklearn's score_samples convention, <= 0)."""
    bc = shared or share_model(spark or df.sparkSession, model)
    feats = model.features
    zm = np.array([model.scaler[f][0] for f in feats])
    zs = np.array([model.scaler[f][1] for f in feats])
    schema = T.StructType(df.schema.fields + [T.StructField("anomaly_raw", T.DoubleType())])
    return df.mapInArrow(_scorer(bc, feats, zm, zs), schema)


def score_events(df: DataFrame, model: ForestModel, norm: str = "batch", shared=None) -> DataFrame:
    """``anomaly_raw`` and ``anomaly_score`` in [0, 1] (1 = most anomalous).

    ``norm="batch"`` writes the scores to the shared checkpoint folder and
    scales by the min/max of this frame's scores (one aggregate over the stored
    column); ``norm="model"`` uses the min/max stored at fit and needs no extra
    pass (works on streams).  ``shared`` is a ``share_model`` broadcast.
    """
    data = spread(df.dropna(subset=model.features))
    raw = score_raw(data, model, shared=shared)
    if norm == "model":
        if model.score_min is None or model.score_max is None:
            raise ValueError("norm='model' needs a calibrated model (fit_forest(calibrate=True))")
        lo, hi = model.score_min, model.score_max
    else:
        raw = stored(raw, "scores")
        mm = raw.agg(F.min("anomaly_raw").alias("lo"), F.max("anomaly_raw").alias("hi")).first()
        if mm["lo"] is None:
            return raw.withColumn("anomaly_score", F.lit(None).cast("double"))
        lo, hi = float(mm["lo"]), float(mm["hi"])
    return raw.withColumn("anomaly_score", min_max_score(F.lit(lo), F.lit(hi)))


def min_max_score(lo, hi):
    """The flipped min-max scaling of ``anomaly_raw``."""
    return F.lit(1.0) - (F.col("anomaly_raw") - lo) / (hi - lo + F.lit(1e-9))


def brute_force_scores(model: ForestModel, x: np.ndarray) -> np.ndarray:
    """Reference traversal, one row and one tree at a time (tests only)."""
    nd = model.nodes
    feats = model.features
    zm = np.array([model.scaler[f][0] for f in feats])
    zs = np.array([model.scaler[f][1] for f in feats])
    z = (x - zm) / zs
    by_tree = {t: g.set_index("node") for t, g in nd.groupby("tree")}
    c = float(c_factor(model.psi))
    out = []
    for row in z:
        total = 0.0
        for t, g in by_tree.items():
            node = 0
            while g.loc[node, "feature"] >= 0:
                f = int(g.loc[node, "feature"])
                node = int(g.loc[node, "left"] if row[f] <= g.loc[node, "threshold"] else g.loc[node, "right"])
            total += g.loc[node, "path"]
        out.append(-2.0 ** (-(total / len(by_tree)) / c))
    return np.array(out)
