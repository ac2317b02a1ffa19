"""Validation, contract checks, quarantine, data-quality statistics and gates.

Q1 validity filter, Q2 contract violations, Q3 quarantine split and reject
statistics, Q4/Q5 defaults, A9/A10 DQ stats and gate, A11 z-score gate and
A12 event-id de-duplication.  All are single-pass aggregate or filter plans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..schema import EVENT_FIELDS
from .joins import attach_small

# --- fixed values: contract rule names, in evaluation order -------------------
RULES = [
    "camera_id_missing", "camera_id_pattern", "event_ts_invalid", "location_missing",
    "latitude_range", "longitude_range", "vehicle_count_range", "average_speed_range",
    "congestion_level_enum", "congestion_score_range", "critical_below_min_score",
    "pedestrian_count_range", "heavy_vehicle_pct_range",
]
DEFAULTS = {"accident_detected": False, "pedestrian_count": 0, "heavy_vehicle_pct": 0.0,
            "producer_version": "2.4.1", "schema_version": "1.0"}


def _inside(c: str, lo_hi) -> Column:
    lo, hi = lo_hi
    return F.coalesce(F.col(c).between(lo, hi), F.lit(False))


def validity_condition() -> Column:
    """Q1: the seven conjuncts of the stream's validity filter (null fails)."""
    return (F.col("camera_id").isNotNull()
            & F.col("vehicle_count").between(*X.VEHICLE_RANGE)
            & F.col("average_speed").between(*X.SPEED_RANGE)
            & F.col("congestion_score").between(*X.SCORE_RANGE)
            & F.col("event_ts").isNotNull()
            & F.col("latitude").between(*X.LAT_RANGE)
            & F.col("longitude").between(*X.LON_RANGE))


def validate(df: DataFrame) -> DataFrame:
    """Q1: keep rows passing every validity rule (bounds inclusive)."""
    return df.filter(validity_condition())


def rule_conditions() -> list[tuple[str, Column]]:
    """Q2: (rule name, failing condition) pairs of the event contract."""
    cam, level, score = F.col("camera_id"), F.col("congestion_level"), F.col("congestion_score")
    conds = {
        "camera_id_missing": cam.isNull(),
        "camera_id_pattern": cam.isNotNull() & ~cam.rlike(X.CAMERA_ID_PATTERN),
        "event_ts_invalid": F.col("event_ts").isNull(),
        "location_missing": F.col("location").isNull(),
        "latitude_range": ~_inside("latitude", X.LAT_RANGE),
        "longitude_range": ~_inside("longitude", X.LON_RANGE),
        "vehicle_count_range": ~_inside("vehicle_count", X.VEHICLE_RANGE),
        "average_speed_range": ~_inside("average_speed", X.SPEED_RANGE),
        "congestion_level_enum": ~F.coalesce(level.isin(X.CONGESTION_LEVELS), F.lit(False)),
        "congestion_score_range": ~_inside("congestion_score", X.SCORE_RANGE),
        "critical_below_min_score": F.coalesce((level == "CRITICAL") & (score < X.CRITICAL_MIN_SCORE),
                                               F.lit(False)),
        "pedestrian_count_range": F.coalesce(F.col("pedestrian_count") < 0, F.lit(False)),
        "heavy_vehicle_pct_range": F.coalesce(~F.col("heavy_vehicle_pct").between(*X.HEAVY_PCT_RANGE),
                                              F.lit(False)),
    }
    return [(r, conds[r]) for r in RULES]


def violations(df: DataFrame) -> DataFrame:
    """Q2: add ``violations array<string>`` (empty when the row is valid)."""
    arr = F.array(*[F.when(c, F.lit(name)) for name, c in rule_conditions()])
    return df.withColumn("violations", F.filter(arr, lambda x: x.isNotNull()))


def any_violation() -> Column:
    """True when at least one contract rule fails (plain boolean, codegen'd)."""
    out = None
    for _, c in rule_conditions():
        out = c if out is None else (out | c)
    return out


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q3: (good rows, quarantined rows with their violations).

    The split is a boolean filter; the per-row violations array (a
    higher-order function) is only built for the quarantined side.
    """
    bad_row = any_violation()
    good = df.filter(~bad_row)
    bad = violations(df.filter(bad_row))
    return good, bad


def reject_stats(df: DataFrame) -> DataFrame:
    """Q3: per-rule reject counts and rates in one global aggregation.

    Output: rule, rejected_rows, total_rows, reject_rate (rule ``any`` = rows
    failing at least one rule).
    """
    conds = rule_conditions()
    any_bad = any_violation()
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    aggs += [F.count_if(c).alias(name) for name, c in conds]
    aggs.append(F.count_if(any_bad).alias("any"))
    wide = df.agg(*aggs)
    names = [name for name, _ in conds] + ["any"]
    long = wide.unpivot(["total_rows"], names, "rule", "rejected_rows")
    return long.select(
        "rule", "rejected_rows", "total_rows",
        F.try_divide(F.col("rejected_rows"), F.col("total_rows")).alias("reject_rate"))


def observe_rejects(df: DataFrame, name: str = "contract_rejects") -> DataFrame:
    """Q3 on streams: per-rule reject counts attached as observed metrics.

    The counts ride along each micro-batch (``StreamingQueryProgress
    .observedMetrics[name]``) without a second query over the data.
    """
    conds = rule_conditions()
    any_bad = any_violation()
    metrics = [F.count(F.lit(1)).alias("total_rows")]
    metrics += [F.count_if(c).alias(r) for r, c in conds]
    metrics.append(F.count_if(any_bad).alias("any"))
    return df.observe(name, *metrics)


def apply_defaults(df: DataFrame) -> DataFrame:
    """Q4/Q5: contract defaults for absent optional fields; score to 2 dp."""
    out = df
    for c, v in DEFAULTS.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out.withColumn("congestion_score", F.round("congestion_score", 2))


# --- A9 / A10 data-quality statistics and gate --------------------------------

def _id_slots(event_id: Column) -> tuple[Column, Column, Column]:
    """(bucket, position, text) of an event id: a number in its usual spelling is a
    bit of its bucket's bitmap; any other id keeps its text (null: neither)."""
    number = event_id.try_cast("long")
    plain = (number > 0) & (number.cast("string") == event_id)
    return (F.when(plain, F.bitmap_bucket_number(number)), F.when(plain, F.bitmap_bit_position(number)),
            F.when(~F.coalesce(plain, F.lit(False)), event_id))


def dq_stats(df: DataFrame, date=None, by_date: bool = True, exact: bool = True,
             rsd: float = 0.01, bitmap: bool = False) -> DataFrame:
    """Total, null_rate, out_of_range, dup_rate (4 dp) per event date.

    ``date`` restricts to one day (partition filter on ``event_date``).  The
    unrounded rates are kept in ``*_raw`` columns for the gate.  The exact
    duplicate rate shuffles every (day, event_id); ``exact=False`` counts
    distinct ids with HyperLogLog (relative error ``rsd``, merged map-side, no
    id shuffle) for days too large to de-duplicate exactly.  ``bitmap=True``
    is exact too: numeric ids become bits of 4 KB bitmaps, one for 32,768
    neighbouring ids, merged map-side, so a bitmap is shuffled instead of its
    ids.  It pays where ids are dense (sequence numbers); other ids are
    de-duplicated as text, and widely scattered numbers cost a bitmap each.
    """
    if "event_date" not in df.columns:
        df = df.withColumn("event_date", F.to_date("event_ts"))
    if date is not None:
        df = df.filter(F.col("event_date") == F.lit(str(date)).cast("date"))
    vc = F.col("vehicle_count")
    keys = ["event_date"] if by_date else []
    counts = {"total": F.count(F.lit(1)),
              "_no_camera": F.count_if(F.col("camera_id").isNull()),
              "_no_count": F.count_if(vc.isNull()),
              "_no_speed": F.count_if(F.col("average_speed").isNull()),
              "_out": F.count_if((vc < X.VEHICLE_RANGE[0]) | (vc > X.VEHICLE_RANGE[1])),
              "_no_id": F.max(F.col("event_id").isNull().cast("int"))}
    aggs = [c.alias(n) for n, c in counts.items()]
    if bitmap:
        bucket, position, text = _id_slots(F.col("event_id"))
        slots = (df.withColumns({"_bucket": bucket, "_position": position, "_text": text})
                 .groupBy(*keys, "_bucket", "_text")
                 .agg(*aggs, F.bitmap_count(F.bitmap_construct_agg("_position")).alias("_bits")))
        stats = slots.groupBy(*keys).agg(
            *[(F.max(n) if n == "_no_id" else F.coalesce(F.sum(n), F.lit(0))).alias(n) for n in counts],
            (F.coalesce(F.sum("_bits"), F.lit(0)) + F.count("_text")).alias("_ids"))
    else:
        ids = F.count_distinct("event_id") if exact else F.approx_count_distinct("event_id", rsd)
        stats = df.groupBy(*keys).agg(*aggs, ids.alias("_ids"))

    def rate(x):
        return F.try_divide(x, F.col("total"))          # empty input -> null, not an error

    out = stats.select(
        *keys, "total",
        ((rate(F.col("_no_camera")) + rate(F.col("_no_count")) + rate(F.col("_no_speed"))) / 3).alias("null_rate_raw"),
        rate(F.col("_out")).alias("out_of_range_raw"),
        rate(F.greatest(F.lit(0), F.col("total") - F.col("_ids") - F.coalesce("_no_id", F.lit(0)))).alias("dup_rate_raw"))
    return out.select(
        *keys, "total",
        F.round("null_rate_raw", 4).alias("null_rate"),
        F.round("out_of_range_raw", 4).alias("out_of_range"),
        F.round("dup_rate_raw", 4).alias("dup_rate"),
        "null_rate_raw", "out_of_range_raw", "dup_rate_raw")


def dq_gate(stats: DataFrame, max_bad: float = 0.05) -> DataFrame:
    """A10: bad_pct = mean of the three unrounded rates; pass iff < max_bad."""
    bad = (F.col("null_rate_raw") + F.col("out_of_range_raw") + F.col("dup_rate_raw")) / 3
    keys = [c for c in ("event_date",) if c in stats.columns]
    return stats.select(
        *keys, "total", "null_rate", "out_of_range", "dup_rate",
        bad.alias("bad_pct"),
        F.when(bad < max_bad, "quality_pass").otherwise("quality_fail").alias("decision"))


# --- A11 z-score gate ----------------------------------------------------------

def zscore_outliers(df: DataFrame, k: float = 3.0, max_share: float = 0.05,
                    key: str = "camera_id") -> DataFrame:
    """Per camera, rows with |z| > k for vehicle_count or average_speed.

    Mean and population std come from exact sums (order independent); a zero
    std gives z = 0.  The per-camera statistics are joined back through a
    size-checked broadcast.
    """
    specs = [("vehicle_count", True, "vc"), ("average_speed", False, "sp")]
    stats = df.groupBy(key).agg(
        *[X.moments_of(c, integral).alias(f"{p}_m") for c, integral, p in specs],
        *[X.mean_of(c, integral).alias(f"{p}_mean") for c, integral, p in specs])
    sel = [key]
    for _, integral, p in specs:
        sel += [f"{p}_mean", X.pop_std_from(F.col(f"{p}_m"), integral).alias(f"{p}_std")]
    stats = stats.select(*sel)
    joined = attach_small(df.select(key, *[c for c, _, _ in specs]), stats, key)

    def z_out(c, p):
        std = F.col(f"{p}_std")
        z = F.when(std > 0, (F.col(c) - F.col(f"{p}_mean")) / std).otherwise(F.lit(0.0))
        return F.coalesce(F.abs(z) > k, F.lit(False))

    vo, so = z_out("vehicle_count", "vc"), z_out("average_speed", "sp")
    out = joined.groupBy(key).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(vo).alias("vehicle_outliers"),
        F.count_if(so).alias("speed_outliers"),
        F.count_if(vo | so).alias("outlier_rows"))
    rate = F.col("outlier_rows") / F.col("events")
    return out.select(key, "events", "vehicle_outliers", "speed_outliers", "outlier_rows",
                      rate.alias("outlier_rate"), (rate <= max_share).alias("zscore_pass"))


# --- A12 de-duplication ----------------------------------------------------------

def _delivery(df: DataFrame) -> Column:
    """Partition and offset of a row as a key, null where either is missing."""
    if not {"kafka_partition", "kafka_offset"} <= set(df.columns):
        return F.lit(None).cast("string")
    return F.concat(F.lit("\u0000"), F.col("kafka_partition").cast("string"), F.lit(":"), F.col("kafka_offset").cast("string"))


def dedup_events(df: DataFrame) -> DataFrame:
    """One row per event_id, the earliest ingest (then lowest offset).

    An aggregate (``min_by``) rather than a window: it combines map-side, so a
    hot event id never lands whole in one task.  Rows without an event id are
    de-duplicated by their (partition, offset) delivery coordinates; without
    those, only rows that agree in every column are one row.
    """
    cols = df.columns
    key = F.coalesce(F.col("event_id"),
                     _delivery(df),
                     F.concat(F.lit("\u0000#"), F.sha2(F.to_json(F.struct(*cols)), 256)))
    # every column takes part, so ties are broken the same way in any partitioning
    order = F.struct(F.col("kafka_ingest_ts"), F.col("kafka_partition"), F.col("kafka_offset"),
                     F.struct(*[F.col(c) for c in cols]))
    agg = (df.withColumn("_k", key)
           .groupBy("_k")
           .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_r")))
    return agg.select(*[F.col("_r." + c).alias(c) for c in cols])


def dedup_stream(df: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Streaming de-duplication by event_id within the watermark.

    Rows without an event id go by their (partition, offset) delivery
    coordinates; without those, rows that agree in every column of the event
    are one: broker and processing times differ from delivery to delivery."""
    event = F.to_json(F.struct(*[F.col(c) for c in EVENT_FIELDS if c in df.columns]))
    key = F.coalesce(F.col("event_id"), _delivery(df), F.concat(F.lit("\u0000#"), F.sha2(event, 256)))
    return df.withWatermark("event_ts", watermark).withColumn("_k", key) \
        .dropDuplicatesWithinWatermark(["_k"]).drop("_k")
