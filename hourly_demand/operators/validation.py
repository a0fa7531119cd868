"""Panel contract and history checks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TS, Y, as_time, check_delay
from ..functions.errors import is_finite
from ..functions.time import floor_hour, hour_index, is_dst_hour, ntz

CHECKS = ("null_time", "off_hour", "duplicate_hour", "missing_hour", "null_value", "not_finite", "negative")


def check_columns(panel: DataFrame, keys: Sequence[str] = ()) -> None:
    """Exactly the keys, the hour and the target; the hour is naive local time."""
    expected = {*keys, TS, Y}
    if set(panel.columns) != expected:
        raise ValueError(f"expected the columns {sorted(expected)}, got {sorted(panel.columns)}")
    if not isinstance(panel.schema[TS].dataType, T.TimestampNTZType):
        raise ValueError(f"{TS} must be TIMESTAMP_NTZ, local time without a zone")
    if not isinstance(panel.schema[Y].dataType, T.NumericType):
        raise ValueError(f"{Y} must be numeric")


def _counted_violations(
    panel: DataFrame, keys: Sequence[str], allow_null: bool, *more: Column
) -> DataFrame:
    """One row per series with the count of each check; `more` are further aggregates over hours."""
    check_columns(panel, keys)
    y = F.col(Y).cast("double")
    off = F.col(TS) != floor_hour(TS)
    bad_null = F.lit(False) if allow_null else (F.col(Y).isNull() | F.isnan(y))
    not_finite = F.col(Y).isNotNull() & ~F.isnan(y) & ~is_finite(Y)
    per_hour = panel.groupBy(*keys, hour_index(TS).alias("_i")).agg(
        F.count("*").alias("_rows"),
        F.max(TS).alias(TS),
        F.count_if(off).alias("_off"),
        F.count_if(bad_null).alias("_null"),
        F.count_if(not_finite).alias("_inf"),
        F.count_if(F.coalesce(y < 0, F.lit(False))).alias("_neg"),
    )
    timed = F.col("_i").isNotNull()
    span = F.max("_i") - F.min("_i") + 1 - F.count("_i")
    found = per_hour.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(~timed, F.col("_rows"))), F.lit(0)).alias("null_time"),
        F.coalesce(F.sum("_off"), F.lit(0)).alias("off_hour"),
        F.coalesce(F.sum(F.when(timed, F.col("_rows") - 1)), F.lit(0)).alias("duplicate_hour"),
        F.coalesce(span, F.lit(0)).alias("missing_hour"),
        F.coalesce(F.sum("_null"), F.lit(0)).alias("null_value"),
        F.coalesce(F.sum("_inf"), F.lit(0)).alias("not_finite"),
        F.coalesce(F.sum("_neg"), F.lit(0)).alias("negative"),
        *more,
    )
    return found


def panel_violations(panel: DataFrame, keys: Sequence[str] = (), allow_null: bool = False) -> DataFrame:
    """Number of offending rows or hours per series and check; a valid panel gives only zeros."""
    found = _counted_violations(panel, keys, allow_null)
    pairs = F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).cast("bigint").alias("n_bad")) for c in CHECKS])
    return found.select(*keys, F.inline(pairs))


def validate_panel(panel: DataFrame, keys: Sequence[str] = (), allow_null: bool = False) -> DataFrame:
    """Returns the panel, or raises ValueError that names the failing checks. Runs a job."""
    worst = panel_violations(panel, keys, allow_null).groupBy("check").agg(F.sum("n_bad").alias("n_bad"))
    bad = {r["check"]: r["n_bad"] for r in worst.collect() if r["n_bad"]}
    if bad:
        raise ValueError(f"invalid panel: {bad}")
    if panel.isEmpty():
        raise ValueError("invalid panel: no rows")
    return panel


def target_hour(target) -> datetime:
    t = as_time(target)
    if t != t.replace(minute=0, second=0, microsecond=0):
        raise ValueError("target must be the start of a local hour")
    return t


def history_status(
    panel: DataFrame,
    target,
    delay: int = 1,
    keys: Sequence[str] = (),
    zone: str = "America/New_York",
    length: int = 168,
) -> DataFrame:
    """Per series: whether its history ends exactly `delay` hours before the target and is complete.

    status is `stale` (ends elsewhere), `invalid` (contract broken), `dst` (a clock change inside
    the last week or before the target), `short` (less than a week) or `ok`.
    """
    check_delay(delay)
    target = target_hour(target)
    last = target - timedelta(hours=delay)
    first = last - timedelta(hours=length - 1)
    recent = F.coalesce(F.sum(F.when(F.col(TS) >= ntz(first), F.col("_rows"))), F.lit(0))
    found = _counted_violations(panel, keys, False, F.max(TS).alias("last_hour"), recent.alias("n_recent"))
    return _judged(found, ntz(last), _crosses_dst(ntz(first), ntz(target), zone), length).select(
        *keys, "last_hour", "n_recent", "n_bad", "status"
    )


def week_status(
    shared: DataFrame, keys: Sequence[str], hour: str, delay: int = 1, zone: str = "America/New_York", length: int = 168
) -> DataFrame:
    """As `history_status`, for the histories up to many hours at once: keys, hour and status of the rows `_closed`.

    shared: keys, hour, `_rows` of the history in it, `_bad` of them, and `_closed`; every hour of the `length` hours
    up to a closed one and of the delay after it comes once. Counts up to the end of a history less those up to its
    beginning are its own.
    """
    check_delay(delay)
    w = Window.partitionBy(*keys).orderBy(hour)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    off = (F.col(hour) != floor_hour(hour)).cast("bigint") * F.col("_rows")
    bad = F.col("_bad") + off + F.greatest(F.col("_rows") - 1, F.lit(0))
    rows = shared.select(*keys, hour, "_closed", "_rows", bad.alias("_bad"), is_dst_hour(hour, zone).cast("bigint").alias("_dst"))
    # Held hours come in runs; two runs in a history leave hours out between them.
    beside = (F.lag("_rows").over(w) > 0) & (F.lag(hour).over(w) + F.expr("INTERVAL '1' HOUR") == F.col(hour))
    rows = rows.withColumn("_start", (F.col("_rows") > 0) & ~F.coalesce(beside, F.lit(False)))
    rows = rows.withColumns({f"_n{c}": F.sum(F.col(c).cast("bigint")).over(running) for c in ("_rows", "_bad", "_start", "_dst")})
    rows = rows.withColumns(
        {
            "_before": F.lag(F.struct("_n_rows", "_n_bad", "_n_start", "_n_dst"), length).over(w),
            "_first": F.lag(F.struct("_rows", "_start"), length - 1).over(w),
            "_target": F.lead("_n_dst", delay).over(w),
        }
    )
    own = lambda c, upto=None: F.coalesce(F.col(upto or c), F.lit(0)) - F.coalesce(F.col("_before")[c], F.lit(0))
    carried = (F.col("_first")["_rows"] > 0) & ~F.col("_first")["_start"]
    runs = own("_n_start") + F.coalesce(carried.cast("int"), F.lit(0))
    status = (
        F.when((own("_n_bad") > 0) | (runs > 1), "invalid")
        .when(F.col("_rows") == 0, "stale")
        .when(own("_n_dst", "_target") > 0, "dst")
        .when(own("_n_rows") != length, "short")
        .otherwise("ok")
    )
    return rows.filter("_closed").select(*keys, hour, status.alias("status"))


def _judged(found: DataFrame, last: Column, crosses_dst: Column, length: int) -> DataFrame:
    total = F.lit(0).cast("bigint")
    for check in CHECKS:
        total = total + F.col(check)
    status = (
        F.when(F.col("n_bad") > 0, "invalid")
        .when(F.coalesce(F.col("last_hour") != last, F.lit(True)), "stale")
        .when(crosses_dst, "dst")
        .when(F.col("n_recent") != length, "short")
        .otherwise("ok")
    )
    return found.withColumn("n_bad", total).withColumn("status", status)


def _crosses_dst(first: Column, target: Column, zone: str) -> Column:
    steps = F.sequence(first, target, F.expr("INTERVAL '1' HOUR"))
    return F.exists(steps, lambda h: is_dst_hour(h, zone))


def current_hour(instant: Column, zone: str = "America/New_York") -> Column:
    """Local hour of the zone at an instant, given as UTC wall time without a zone."""
    return floor_hour(F.convert_timezone(F.lit("UTC"), F.lit(zone), instant))


def live_check(spark: SparkSession, target, as_of: str | datetime, zone: str = "America/New_York") -> DataFrame:
    """Whether the target is the current local hour at the instant `as_of`, which must carry a zone."""
    instant = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(str(as_of))
    if instant.tzinfo is None:
        raise ValueError("as_of must carry a time zone")
    utc = ntz(instant.replace(tzinfo=None) - instant.utcoffset())
    wanted = ntz(target_hour(target))
    return spark.range(1).select(
        wanted.alias("target"),
        current_hour(utc, zone).alias("current_hour"),
        (wanted == current_hour(utc, zone)).alias("ok"),
    )
