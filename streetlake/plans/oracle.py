"""DuckDB twins of the exact-arithmetic expressions (oracle SQL helpers)."""

from __future__ import annotations

from ..sources.fixtures import ADAPTER_SQL


def _units(c: str) -> str:
    """A group's exact sum in billionths, a 128-bit integer."""
    return f"cast(sum(cast({c} * cast(1000000000 as double) as bigint)) as hugeint)"


def mean(c: str) -> str:
    return f"(cast({_units(c)} as double) / cast(1000000000 as double) / count({c}))"


def imean(c: str) -> str:
    return f"(cast(sum({c}) as double) / count({c}))"


def rnd(x: str, d: int) -> str:
    """Spark's round(double, d) (half-up on the decimal text)."""
    return f"cast(round(cast(cast(({x}) as varchar) as decimal(38,20)), {d}) as double)"


def isum(x: str) -> str:
    return f"cast(sum({x}) as bigint)"


def speed_index(c: str = "average_speed") -> str:
    return rnd(f"{c} / cast(120.0 as double)", 4)


def pop_std(c: str, integral: bool) -> str:
    """Population std about the whole part of the mean, in 128-bit integers."""
    unit = 1 if integral else 1_000_000_000
    m = f"cast({c} as hugeint)" if integral else f"cast({c} * cast(1000000000 as double) as hugeint)"
    n, s, q = f"count({c})", f"cast(sum({m}) as hugeint)", f"cast(sum({m} * {m}) as hugeint)"
    p = f"({s} // {n})"
    r = f"({s} - {p} * {n})"
    about = f"({q} - {p} * ({s} + {r}))"
    square = f"cast({unit * unit} as hugeint)"
    spread = (f"(cast({about} // {square} as double) + cast({about} % {square} as double) "
              f"/ cast({unit * unit} as double))")
    over = f"(cast({r} as double) / cast({unit} as double))"
    return f"sqrt(greatest(({spread} - {over} * {over} / {n}) / {n}, 0.0))"


def with_adapter(*ctes: str, body: str, adapter: str = ADAPTER_SQL) -> str:
    """Adapter views + extra CTEs + the final SELECT."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"{adapter}{extra}\n{body}"
