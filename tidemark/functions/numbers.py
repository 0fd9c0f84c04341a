"""Guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(x: Column, y: Column) -> Column:
    """x / y, null where y is zero."""
    return x.cast("double") / F.nullif(y.cast("double"), F.lit(0.0))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def when_call(kind: Column, call: Column, put: Column, other: Column | None = None) -> Column:
    out = F.when(kind == "Call", call).when(kind == "Put", put)
    return out if other is None else out.otherwise(other)


def sum_if(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def interpolate(x: Column, knots: list[tuple[float, float]]) -> Column:
    """Straight lines between knots, flat beyond them."""
    out = F.when(x <= knots[0][0], F.lit(knots[0][1]))
    for (x0, y0), (x1, y1) in zip(knots, knots[1:]):
        out = out.when(x <= x1, F.lit(y0) + (x - x0) * ((y1 - y0) / (x1 - x0)))
    return out.otherwise(F.lit(knots[-1][1]))


def half_step(x: Column) -> Column:
    """Nearest multiple of 0.5, halves to even."""
    return F.bround(x * 2) / 2
