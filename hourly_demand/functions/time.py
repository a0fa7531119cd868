"""Local-time expressions on TIMESTAMP_NTZ that do not depend on the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def hours(n) -> Column:
    """Interval of n hours; n is a number or an integer column."""
    return F.make_dt_interval(F.lit(0), n if isinstance(n, Column) else F.lit(n))


def days(n) -> Column:
    return F.make_dt_interval(n if isinstance(n, Column) else F.lit(n))


def floor_hour(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(c).cast("timestamp_ntz") + hours(F.hour(c))


def scan_hour(ts: str | Column) -> Column:
    """The same as `floor_hour` by plain arithmetic, for the projection of large scans.

    Spark drops rows whose time is NULL here, so the time must not be NULL.
    """
    return F.window(ts, "1 hour")["start"]


def floor_day(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(c).cast("timestamp_ntz")


def hour_index(ts: str | Column) -> Column:
    """Whole hours since 1970 on the local clock; consecutive hours differ by one."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")) * 24 + F.hour(c)


def from_hour_index(idx: str | Column) -> Column:
    c = F.col(idx) if isinstance(idx, str) else idx
    return F.expr(EPOCH) + hours(c.cast("int"))


def is_dst_hour(ts: str | Column, zone: str) -> Column:
    """True for a local hour that does not exist or exists twice in the zone."""
    t = F.col(ts) if isinstance(ts, str) else ts
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), t)

    def back(u: Column) -> Column:
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), u)

    return (back(utc) != t) | (back(utc + hours(1)) == t) | (back(utc - hours(1)) == t)


def in_span(ts: str | Column, start: datetime | None, end: datetime | None) -> Column:
    """Half-open range test; an open side is None."""
    c = F.col(ts) if isinstance(ts, str) else ts
    out = F.lit(True)
    if start is not None:
        out = c >= ntz(start)
    if end is not None:
        out = (out & (c < ntz(end))) if start is not None else c < ntz(end)
    return out
