"""Causal feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TS, Y
from ..functions.calendar import calendar, cycles, holiday_flag
from ..functions.time import hour_index, in_span
from ..operators.groups import attach
from ..operators.windows import CHUNK_HOURS, WINDOWS, lag_offsets, lags_and_rolling

# Names of the calendar features.
CALENDAR = [
    "hour",
    "weekday",
    "is_weekend",
    "is_holiday",
    "hour_sin",
    "hour_cos",
    "weekday_sin",
    "weekday_cos",
]


def feature_sets(delay: int = 1) -> dict[str, list[str]]:
    """Column names of the nested feature sets."""
    lagged = CALENDAR + [f"lag_{k}" for k in lag_offsets(delay)]
    rolled = [f"roll_{stat}_{w}" for w in WINDOWS for stat in ("mean", "std")]
    return {"calendar": list(CALENDAR), "lags": lagged, "full": lagged + rolled}


def calendar_features(df: DataFrame) -> DataFrame:
    return cycles(holiday_flag(calendar(df)))


def features(
    panel: DataFrame, delay: int = 1, keys: Sequence[str] = (), chunk_hours: int = CHUNK_HOURS, checked: bool = False
) -> DataFrame:
    """Calendar, lag and trailing-window features of every hour of every series.

    Lags and windows take one shuffle and one sort; the calendar part is computed on the rows.
    `checked` adds `violation`, how a row breaks the contract of a panel, found on the same sorted
    rows: no_time, off_hour, duplicate_hour, missing_hour (before it), not_finite or negative, else
    NULL. `series_status` turns it into a status per series.
    """
    table = lags_and_rolling(panel, delay, keys, chunk_hours=chunk_hours, row_columns=calendar_features, checked=checked)
    return table.select(*keys, TS, Y, *feature_sets(delay)["full"], *(["violation"] if checked else []))


def series_status(table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows, violations and status (ok, invalid) per series of a checked feature table.

    Counts combine before they are shuffled, so the rows do not move again. Missing hours follow from
    first and last hour and the number of hours between, so a gap of any length counts.
    """
    hour = hour_index(TS)
    at = lambda code: F.count_if(F.col("violation") == code)
    found = table.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.max(hour) - F.min(hour) + 1 - (F.count(hour) - at("duplicate_hour"))).alias("n_missing"),
        *[at(code).alias(f"n_{code}") for code in ("no_time", "off_hour", "duplicate_hour", "not_finite", "negative")],
    )
    found = found.withColumn("n_missing", F.coalesce("n_missing", F.lit(0)).cast("bigint"))
    total = sum((F.col(c) for c in found.columns if c.startswith("n_") and c != "n_rows"), F.lit(0))
    return found.withColumn("status", F.when(total > 0, "invalid").otherwise("ok"))


def complete_rows(table: DataFrame) -> DataFrame:
    """Rows without any NULL.

    A full trailing week without NULL contains every lag and every shorter window, so in a feature
    table it stands for all of them; testing each column would compute each of them twice.
    """
    week = f"roll_mean_{max(WINDOWS)}"
    if week not in table.columns:
        return table.dropna()
    implied = [c for c in table.columns if c.startswith(("lag_", "roll_")) or c in CALENDAR]
    return table.dropna(subset=[c for c in table.columns if c not in implied] + [week])


def period_slice(table: DataFrame, start=None, end=None) -> DataFrame:
    """Rows of [start, end); either end may be open."""
    return table.filter(in_span(TS, start, end))


def scaling(table: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation of each column; a deviation of zero counts as 1."""
    out = []
    for c in cols:
        v = F.col(c).cast("double")
        spread = F.stddev_pop(v)
        flat = F.min(v) == F.max(v)
        out += [F.avg(v).alias(f"{c}_mean"), F.when(flat, F.lit(1.0)).otherwise(spread).alias(f"{c}_std")]
    return table.groupBy(*by).agg(*out)


def standardise(table: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Centres columns and divides them by their population deviation."""
    stats = scaling(table, cols, by)
    joined = attach(table, stats, by)
    made = {f"{c}_z": (F.col(c) - F.col(f"{c}_mean")) / F.col(f"{c}_std") for c in cols}
    return joined.withColumns(made).select(*table.columns, *made)
