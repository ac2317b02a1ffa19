"""Property tests: Spark rule evaluation equals a plain-Python reading."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from streetlake.functions import exprs as X
from streetlake.operators import quality as Q
from tests.test_operators import EV_COLS

T0 = dt.datetime(2024, 1, 1)


def _maybe(s):
    return st.one_of(st.none(), s)


def edge_float(lo, hi):
    """Boundary values (inclusive bounds and just outside) or any float nearby."""
    return st.one_of(st.sampled_from([float(lo), float(hi), lo - 0.1, hi + 0.1, 0.0]),
                     st.floats(lo - 50, hi + 50, allow_nan=False))

event = st.tuples(
    st.text("0123456789", min_size=1, max_size=4),
    _maybe(st.sampled_from(["CAM_01", "CAM_12", "CAM_1", "XCAM_03", "cam_04"])),
    _maybe(st.just(T0)),
    _maybe(st.just("L")),
    _maybe(edge_float(-90, 90)), _maybe(edge_float(-180, 180)),
    _maybe(st.integers(-5, 2100)), _maybe(edge_float(0, 200)),
    _maybe(st.sampled_from(["LOW", "MEDIUM", "HIGH", "CRITICAL", "SEVERE"])),
    _maybe(edge_float(0, 100)), _maybe(st.booleans()), _maybe(st.integers(-3, 90)),
    _maybe(edge_float(0, 100)),
)


def _between(v, lo, hi):
    return v is not None and lo <= v <= hi


def py_valid(r):
    _, cam, ts, _, lat, lon, vc, spd, _, score, *_ = r
    return (cam is not None and _between(vc, *X.VEHICLE_RANGE) and _between(spd, *X.SPEED_RANGE)
            and _between(score, *X.SCORE_RANGE) and ts is not None and _between(lat, *X.LAT_RANGE)
            and _between(lon, *X.LON_RANGE))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=1, max_size=120))
def test_validity_and_split_match_python(spark, rows):
    rows = [(f"{i}-{r[0]}",) + r[1:] for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, EV_COLS)
    got = {r.event_id for r in Q.validate(df).collect()}
    assert got == {r[0] for r in rows if py_valid(r)}
    good, bad = Q.split_quarantine(df)
    g = {r.event_id for r in good.collect()}
    b = {r.event_id: r.violations for r in bad.collect()}
    assert g.isdisjoint(b) and g | set(b) == {r[0] for r in rows}
    assert all(len(v) > 0 for v in b.values())
    assert g <= got                      # contract-clean rows also pass the validity filter
