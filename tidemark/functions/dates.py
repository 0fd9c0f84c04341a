"""Calendar helpers. Days of the week count from Sunday = 0 throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dow0(d: Column) -> Column:
    return F.dayofweek(d) - 1


def monday(d: Column) -> Column:
    return F.trunc(d, "week")


def third_friday(d: Column) -> Column:
    """Third Friday of the month of d."""
    first = F.trunc(d, "month")
    return F.date_add(first, (19 - dow0(first)) % 7 + 14)


def week_friday(d: Column) -> Column:
    """Friday of the week that runs from Sunday to Saturday, so a Saturday belongs to the day before."""
    return F.date_add(d, 5 - dow0(d))


def next_opex(d: Column) -> Column:
    """The first third Friday on or after d."""
    own = third_friday(d)
    return F.when(own >= d, own).otherwise(third_friday(F.add_months(F.trunc(d, "month"), 1)))


def quarter_end(d: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("long")


def is_gap_time(local: Column, zone: str) -> Column:
    """A local time that the zone skips when clocks go forward."""
    return F.from_utc_timestamp(F.to_utc_timestamp(local, zone), zone) != local


def is_double_time(local: Column, zone: str) -> Column:
    """A local time that occurs twice when clocks go back."""
    utc = F.to_utc_timestamp(local, zone)
    again = [F.from_utc_timestamp(utc + F.expr(f"INTERVAL {s} HOUR"), zone) == local for s in ("1", "-1")]
    return ~is_gap_time(local, zone) & (again[0] | again[1])


def fiscal_quarter(month: Column) -> Column:
    return F.concat(F.lit("Q"), F.floor((month - 1) / 3 + 1).cast("int").cast("string"))
