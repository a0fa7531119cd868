"""Calendar features of a local hour."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TS

# Fixed values: (month, day, first year) of the federal holidays with a fixed date.
FIXED_DATE_HOLIDAYS = [(1, 1, 1), (6, 19, 2021), (7, 4, 1), (11, 11, 1), (12, 25, 1)]
# Fixed values: (month, weekday with Monday = 0, first possible day, first year) of the others.
NTH_WEEKDAY_HOLIDAYS = [
    (1, 0, 15, 1986),
    (2, 0, 15, 1),
    (5, 0, 25, 1),
    (9, 0, 1, 1),
    (10, 0, 8, 1),
    (11, 3, 22, 1),
]
CYCLES = {"hour": 24, "weekday": 7}


def is_federal_holiday(ts: str | Column) -> Column:
    """True on the observed day: Saturday dates move to Friday, Sunday dates to Monday."""
    date = F.to_date(F.col(ts) if isinstance(ts, str) else ts)
    weekday = F.weekday(date)
    # The calendar date a holiday must have to be observed on this day.
    options = [(date, weekday < 5), (F.date_add(date, 1), weekday == 4), (F.date_sub(date, 1), weekday == 0)]
    found = F.lit(False)
    for nominal, allowed in options:
        hit = F.lit(False)
        for month, day, first_year in FIXED_DATE_HOLIDAYS:
            hit = hit | (
                (F.month(nominal) == month) & (F.dayofmonth(nominal) == day) & (F.year(nominal) >= first_year)
            )
        found = found | (allowed & hit)
    for month, wd, first_day, first_year in NTH_WEEKDAY_HOLIDAYS:
        found = found | (
            (F.month(date) == month)
            & (weekday == wd)
            & F.dayofmonth(date).between(first_day, first_day + 6)
            & (F.year(date) >= first_year)
        )
    return found


def calendar(df: DataFrame, ts: str = TS) -> DataFrame:
    """Adds hour, weekday (Monday = 0) and is_weekend."""
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "weekday": F.weekday(ts),
            "is_weekend": (F.weekday(ts) >= 5).cast("int"),
        }
    )


def holiday_flag(df: DataFrame, ts: str = TS) -> DataFrame:
    return df.withColumn("is_holiday", is_federal_holiday(ts).cast("int"))


def cycles(df: DataFrame, periods: dict[str, int] = CYCLES) -> DataFrame:
    """Adds the sine and cosine of each column over its period."""
    out = {}
    for name, period in periods.items():
        angle = F.col(name) * F.lit(2 * math.pi) / F.lit(period)
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return df.withColumns(out)
