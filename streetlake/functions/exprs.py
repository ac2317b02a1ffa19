"""Scalar and aggregate column expressions shared by all operators.

Everything here is a built-in Spark expression (no UDF), so it stays inside
whole-stage codegen and works the same on batch and streaming frames.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values of the event contract ------------------------------------
# Category cut points (score >= cut), peak hours and validity bounds.
CATEGORY_CUTS = [(75, "CRITICAL"), (50, "HIGH"), (25, "MEDIUM")]
CATEGORY_DEFAULT = "LOW"
STATUS_CUTS = [(75, "critical"), (50, "high"), (25, "medium")]
STATUS_DEFAULT = "normal"
PEAK_HOURS = [7, 8, 9, 16, 17, 18]
CONGESTION_LEVELS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
CAMERA_ID_PATTERN = r"^CAM_\d{2}$"
VEHICLE_RANGE = (0, 2000)
SPEED_RANGE = (0, 200)
SCORE_RANGE = (0, 100)
LAT_RANGE = (-90, 90)
LON_RANGE = (-180, 180)
HEAVY_PCT_RANGE = (0, 100)
SPEED_INDEX_DIVISOR = 120.0
CRITICAL_MIN_SCORE = 75

# Sensor values are summed as integer counts of billionths, cut into a high and
# a low limb of 20 bits: exact, independent of summation order and partitioning,
# codegen'd long arithmetic per row.  For values up to 1,000 no sum can overflow
# before about 8e12 rows a group (squares included).
NANO = 1_000_000_000
LIMB_BITS = 20
LIMB = 1 << LIMB_BITS


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_value(as_of) -> Column:
    """An ``as_of`` argument as a timestamp Column (None -> now)."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.datetime, _dt.date)):
        return F.lit(as_of).cast("timestamp")
    return F.lit(str(as_of)).cast("timestamp")


def nanos(c) -> Column:
    """A value as an integer count of billionths (nine decimals are kept)."""
    return F.rint(col(c) * F.lit(float(NANO))).cast("long")


def _limbs(m: Column) -> tuple[Column, Column]:
    """(high, low) with m = high * LIMB + low and 0 <= low < LIMB."""
    return F.shiftright(m, LIMB_BITS), m.bitwiseAND(F.lit(LIMB - 1).cast("long"))


def _join_sums(digits: list[Column], bits: int) -> Column:
    """sum(digit[i] << (bits * i)) as decimal(38,0), from one long sum a digit."""
    total = F.lit(0).cast("decimal(38,0)")
    for i, d in enumerate(digits):
        weight = F.lit(1 << (bits * i)).cast("decimal(20,0)")
        total = (total + (F.sum(d).cast("decimal(20,0)") * weight).cast("decimal(38,0)")).cast("decimal(38,0)")
    return total


def _sum_wide(m: Column) -> Column:
    """Exact sum of longs as decimal(38,0)."""
    high, low = _limbs(m)
    return _join_sums([low, high], LIMB_BITS)


def _sum_squares_wide(m: Column) -> Column:
    """Exact sum of m * m as decimal(38,0): the square's four digits to the base
    LIMB, carried from the products of m's limbs, are summed apart."""
    high, low = _limbs(m)
    carry, d0 = _limbs(low * low)
    carry, d1 = _limbs(F.lit(2) * high * low + carry)
    d3, d2 = _limbs(high * high + carry)
    return _join_sums([d0, d1, d2, d3], LIMB_BITS)


def mean_of(c, integral: bool = False) -> Column:
    """Order-independent exact mean: exact sum / count (null for no rows)."""
    return F.try_divide(exact_sum(c, integral).cast("double"), F.count(col(c)))


def exact_sum(c, integral: bool = False) -> Column:
    """Exact sum (long for integers; else the double of the exact sum)."""
    return F.sum(col(c)) if integral else _sum_wide(nanos(c)).cast("double") / F.lit(float(NANO))


def moments_of(c, integral: bool = False) -> Column:
    """A group's (n, s, q) struct: count, exact sum and exact sum of squares, in
    units (32-bit integers) or billionths."""
    if integral:
        m = col(c).cast("long")
        square = m * m
        s = F.sum(m).cast("decimal(38,0)")
        q = _join_sums([square.bitwiseAND(F.lit((1 << 31) - 1).cast("long")), F.shiftright(square, 31)], 31)
    else:
        m = nanos(c)
        s, q = _sum_wide(m), _sum_squares_wide(m)
    return F.struct(F.count(col(c)).alias("n"), s.alias("s"), q.alias("q"))


def pop_std_from(moments: Column, integral: bool | Column = False) -> Column:
    """Population std from ``moments_of``, without cancellation: squares are taken
    about the whole part p of the mean in integers, and only the remainder r of
    the sum (0 <= r < n) is subtracted in floating point.  Null for no rows.
    ``integral`` as ``moments_of`` was given it, or a boolean column."""
    integral = integral if isinstance(integral, Column) else F.lit(integral)
    unit = F.when(integral, F.lit(1)).otherwise(F.lit(NANO)).cast("long")
    n, s, q = moments["n"].cast("decimal(20,0)"), moments["s"], moments["q"]
    p = F.floor(F.try_divide(s, n)).cast("decimal(20,0)")
    r = (s - p * n).cast("decimal(38,0)")
    about = (q - (p * (s + r)).cast("decimal(38,0)")).cast("decimal(38,0)")      # q - 2ps + npp = q - p(s + r)
    square = (unit * unit).cast("decimal(20,0)")
    whole = F.floor(about / square).cast("decimal(38,0)")
    rest = (about - whole * square).cast("decimal(38,0)")
    spread = whole.cast("double") + rest.cast("double") / (unit * unit).cast("double")
    over = r.cast("double") / unit.cast("double")
    count = moments["n"].cast("double")
    var = F.try_divide(spread - F.try_divide(over * over, count), count)
    return F.sqrt(F.when(var < 0, F.lit(0.0)).otherwise(var))


def congestion_category(score="congestion_score") -> Column:
    s = col(score)
    expr = None
    for cut, name in CATEGORY_CUTS:
        expr = F.when(s >= cut, name) if expr is None else expr.when(s >= cut, name)
    return expr.otherwise(CATEGORY_DEFAULT)


def congestion_status(score="congestion_score") -> Column:
    s = col(score)
    expr = None
    for cut, name in STATUS_CUTS:
        expr = F.when(s >= cut, name) if expr is None else expr.when(s >= cut, name)
    return expr.otherwise(STATUS_DEFAULT)


def speed_index(speed="average_speed") -> Column:
    return F.round(col(speed) / F.lit(SPEED_INDEX_DIVISOR), 4)


def pct_above(count="vehicle_count", base="baseline_vehicle_count") -> Column:
    """round((count - base) / (base + 1) * 100, 1)."""
    c, b = col(count).cast("double"), col(base)
    return F.round((c - b) / (b + F.lit(1.0)) * F.lit(100.0), 1)


def is_peak_hour(ts="event_ts") -> Column:
    return F.hour(col(ts)).isin(PEAK_HOURS)


def pct_change(cur: Column, prev: Column) -> Column:
    """Percent change vs previous, null when previous is null or zero."""
    p = prev.cast("double")
    return F.when(p != 0, F.round((cur.cast("double") - p) * F.lit(100.0) / p, 1))


def nonzero_round(x: Column, d: int) -> Column:
    """round(x, d), null when x is null or 0 (report convention)."""
    return F.when(x != 0, F.round(x, d))


def partition_range(cols, lo: Column, hi: Column) -> Column | None:
    """Predicate on the clean zone's partition columns implied by
    ``lo <= event_ts <= hi`` (event_date = to_date(event_ts), event_hour =
    hour(event_ts)), so the planner prunes day and hour directories.
    Returns None when the frame has no such columns."""
    if "event_date" not in cols:
        return None
    d_lo, d_hi = F.to_date(lo), F.to_date(hi)
    pred = F.col("event_date").between(d_lo, d_hi)
    if "event_hour" in cols:
        d, h = F.col("event_date"), F.col("event_hour")
        pred = pred & ((d > d_lo) | (h >= F.hour(lo))) & ((d < d_hi) | (h <= F.hour(hi)))
    return pred
