"""Quality classifier: random Fourier features, ridge, isotonic calibration.

Statistics of a text (lengths, character classes, repetition) are scaled with
the mean and deviation of the training rows and mapped to cosines that
approximate a Gaussian kernel.  Every partition of the training rows adds up
its part of the normal equations; the summed system (its size is fixed by
``N_FEATURES``) is solved on the driver.  Rows of another fold give score bins
(a fixed number), whose label means are made monotone by pooling neighbours.

Defined results: null or empty text has zero statistics and a score like any
other; rows without a label, or whose label is null, don't train; without
training rows every score is 0.5; a null id is never held out; repeated rows
get equal scores; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import dataclasses
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetlake.llm.common import fold_of, rows_of, ship_package, stage, text_bytes

N_FEATURES = 128
RIDGE = 1e-3
BINS = 512                      # score bins for the calibration
HOLD_OUT, CALIBRATE = 0, 4      # remainders of crc32(doc_id) mod 5
THRESHOLD = 0.3

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_WHITE = b" \t\n\r\x0b\f"
_SYMBOL = b"#*$%&<>|@^~_=+\\/{}[]"
_STOP = b".,;:?"
_HIGH = bytes(range(128, 256))
CLASSES = (_UPPER, _LOWER, _DIGIT, _WHITE, _SYMBOL, _STOP, b"!", b"|", _HIGH)
N_STATS = len(CLASSES) + 10


def statistics(text: bytes) -> list[float]:
    """Statistics of one text in UTF-8."""
    n = len(text)
    if not n:
        return [0.0] * N_STATS
    shares = [(n - len(text.translate(None, c))) / n for c in CLASSES]
    words = text.split()
    m = len(words)
    if not m:
        return shares + [0.0] * (N_STATS - len(shares))
    counts = Counter(words)
    lens = np.fromiter(map(len, words), np.int64, m)
    lines = [x for x in text.split(b"\n") if x.strip()]
    again = sum(map(bytes.__eq__, words, words[1:]))
    ends = sum(1 for w in words if w[-1] in b"#*$%&!|")
    return shares + [
        np.log1p(n), np.log1p(m), len(counts) / m, max(counts.values()) / m, again / m,
        float(lens.mean()), float(lens.std()), float((lens <= 3).mean()),
        1 - len(set(lines)) / max(1, len(lines)), ends / m,
    ]


@dataclasses.dataclass
class QualityModel:
    """Everything that scoring needs; its size doesn't depend on the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray       # raw scores
    levels: np.ndarray      # calibrated scores at the knots

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        phi = np.cos(z @ self.omega + self.phase) * np.sqrt(2 / self.omega.shape[1])
        return np.hstack([phi, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted least-squares non-decreasing fit of y (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for v, n in zip(y, w):
        blocks.append([v, n, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            n = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / n, n, a[2] + b[2]])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and its statistics."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in rows_of(whole, 1024):
                stats = [statistics(raw.as_py()) for raw in b.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(stats, pa.list_(pa.float64()))], names=["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes("text").alias("text")) \
        .mapInArrow(run, "doc_id long, stats array<double>")


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(len(column), -1)


def fit(stats: DataFrame, labels: DataFrame, seed: int = 7) -> QualityModel:
    """Train on staged statistics and the labels outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y")) \
        .where("doc_id is not null and y is not null")
    rows = stage(stats.join(known, "doc_id").select("stats", "y", fold_of("doc_id").alias("fold"))
                 .where(F.col("fold") != HOLD_OUT), "quality-train")
    train = rows.where(F.col("fold") != CALIBRATE)
    cols = [F.col("stats")[i] for i in range(N_STATS)]
    sums = train.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    rng = np.random.default_rng(seed)
    none = np.zeros(0)
    omega = rng.normal(0, 1 / np.sqrt(N_STATS / 2), (N_STATS, N_FEATURES))
    phase = rng.uniform(0, 2 * np.pi, N_FEATURES)
    if not sums["n"]:
        return QualityModel(np.zeros(N_STATS), np.ones(N_STATS), omega, phase, np.zeros(N_FEATURES + 1), none, none)
    mean = np.array([sums[f"m{i}"] for i in range(N_STATS)])
    scale = np.array([sums[f"s{i}"] for i in range(N_STATS)])
    model = QualityModel(mean, np.where(scale > 1e-9, scale, 1.0), omega, phase,
                         np.zeros(N_FEATURES + 1), none, none)
    size = N_FEATURES + 2                                   # features, constant, label
    upper = np.triu_indices(size)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((size, size)), 0
        for b in batches:
            if b.num_rows:
                y = b.column("y").to_numpy(zero_copy_only=False)
                phi = np.hstack([model.features(_matrix(b.column("stats"))), y[:, None]])
                total += phi.T @ phi
                seen += b.num_rows
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(upper[0])), pa.int32()), pa.array(total[upper])], names=["k", "v"])

    parts = train.select("stats", "y").mapInArrow(equations, "k int, v double")
    # one row per entry of the system, whatever the number of rows
    entries = parts.groupBy("k").agg(F.sum("v").alias("v")).collect()
    system = np.zeros((size, size))
    for r in entries:
        system[upper[0][r["k"]], upper[1][r["k"]]] = r["v"]
    system = system + system.T - np.diag(np.diag(system))
    n = size - 1
    model.weights = np.linalg.solve(system[:n, :n] + RIDGE * sums["n"] / n * np.eye(n), system[:n, n])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                raw = np.clip(model.raw(_matrix(b.column("stats"))), -1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.floor((raw + 1) / 3 * BINS).astype(np.int32)), pa.array(raw), b.column("y")],
                    names=["bin", "raw", "y"])

    held = rows.where(F.col("fold") == CALIBRATE)
    if not held.limit(1).count():
        held = train
    bins = held.select("stats", "y").mapInArrow(binned, "bin int, raw double, y double").groupBy("bin") \
        .agg(F.avg("raw").alias("x"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("w")).collect()
    bins.sort(key=lambda r: r["x"])
    x, y, w = (np.array([r[c] for r in bins], float) for c in ("x", "y", "w"))
    model.knots, model.levels = x, isotonic(x, y, w)
    return model


def score(stats: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for staged statistics."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s = model.score(_matrix(b.column("stats")))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("held_out"), pa.array(s),
                     pa.array((s >= threshold).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    return stats.select("doc_id", (fold_of("doc_id") == HOLD_OUT).alias("held_out"), "stats") \
        .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train and score: one row per document."""
    stats = stage(document_statistics(docs), "quality-stats")
    return score(stats, fit(stats, labels))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least ``threshold``, all their columns as
    they were; texts are scored where they are read, without a shuffle."""
    model = fit(stage(document_statistics(docs), "quality-stats"), labels)
    ship_package(docs.sparkSession)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in rows_of(whole, 1024):
                stats = np.array([statistics(raw.as_py()) for raw in b.column(len(names))])
                yield b.select(range(len(names))).filter(pa.array(model.score(stats) >= threshold))

    return docs.withColumn("__bytes", text_bytes("text")).mapInArrow(run, docs.schema)
