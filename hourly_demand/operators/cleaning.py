"""Trip cleaning: ordered exclusive rejects and hourly counts from one pass over the trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TS, Y, Rules
from ..functions.time import in_span, ntz, scan_hour

VERDICTS = ("date", "values", "zone", "kept")


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts columns; a value that cannot be parsed becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def valid_values(rules: Rules) -> Column:
    """Distance in (0, max] and amount in [0, max].

    NaN sorts above every number in Spark, so the upper limits also reject NaN and infinity.
    """
    d, a = F.col("trip_distance"), F.col("total_amount")
    return (d > 0) & (d <= rules.max_distance) & (a >= 0) & (a <= rules.max_amount)


def in_period(trips: DataFrame, rules: Rules) -> Column:
    """Inside [start, end); trips that carry the month of their file must lie in that month too."""
    ok = in_span("pickup_datetime", rules.start, rules.end)
    if "file_month" in trips.columns:
        ok = ok & (F.trunc("pickup_datetime", "month") == F.col("file_month"))
    return ok


def _holds(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))


def before_zone(trips: DataFrame, rules: Rules) -> Column:
    """First failing rule among date and values, or `ok`; a missing value fails its rule."""
    outside, invalid = ~_holds(in_period(trips, rules)), ~_holds(valid_values(rules))
    return F.when(outside, "date").when(invalid, "values").otherwise("ok")


def _zone_verdict(before: Column, known: Column) -> Column:
    return F.when(before != "ok", before).when(known.isNull(), "zone").otherwise("kept")


def _markers(zones: DataFrame) -> DataFrame:
    return zones.select("zone_id").distinct().withColumn("_known", F.lit(1))


def in_zones(trips: DataFrame, zones: DataFrame, on: str = "zone_id") -> DataFrame:
    """Trips whose zone belongs to the set."""
    return trips.join(zones.select(on), on, "left_semi")


def with_zone_verdict(marked: DataFrame, zones: DataFrame, before: str = "_before") -> DataFrame:
    """`verdict` from the outcome of the rules before the zone rule, for trips or counts of them."""
    joined = marked.join(_markers(zones), "zone_id", "left")
    return joined.withColumn("verdict", _zone_verdict(F.col(before), F.col("_known"))).drop(before, "_known")


def classify(trips: DataFrame, rules: Rules, zones: DataFrame) -> DataFrame:
    """Adds `verdict` to every trip: the first failing rule, or `kept`."""
    return with_zone_verdict(trips.withColumn("_before", before_zone(trips, rules)), zones)


def verdict_cube(trips: DataFrame, zones: DataFrame, rules: Rules) -> DataFrame:
    """Trip counts per zone, hour and verdict: the one pass over the trips.

    The date and value rules are evaluated on the scan and counted before any join, so only
    partial counts are shuffled and a busy zone costs no more than a quiet one. The zone rule
    is applied to the counts. Hours of date rejects are dropped because they are unbounded.
    """
    months = ["file_month"] if "file_month" in trips.columns else []
    never_null = F.coalesce("pickup_datetime", ntz(rules.start))
    cube = (
        trips.select(*months, "zone_id", scan_hour(never_null).alias("_hour"), before_zone(trips, rules).alias("_before"))
        .select(*months, "zone_id", F.when(F.col("_before") != "date", F.col("_hour")).alias(TS), "_before")
        .groupBy(*months, "zone_id", TS, "_before")
        .agg(F.count("*").alias("n"))
    )
    return cube.join(_markers(zones), "zone_id", "left").select(
        *months, "zone_id", TS, _zone_verdict(F.col("_before"), F.col("_known")).alias("verdict"), "n"
    )


def hourly_counts(cube: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Kept trips per series and hour; hours without trips are absent."""
    return cube.filter(F.col("verdict") == "kept").groupBy(*keys, TS).agg(F.sum("n").alias(Y))


def kept_counts(trips: DataFrame, zones: DataFrame, rules: Rules, keys: Sequence[str] = ()) -> DataFrame:
    """Kept trips per zone and hour when no audit is wanted.

    The date and value rules are plain filters here, so they reach the Parquet scan and skip
    files and row groups.
    """
    on = list(dict.fromkeys(["zone_id", *keys]))
    kept = trips.filter(in_period(trips, rules) & valid_values(rules))
    per_zone = kept.select(*on, scan_hour("pickup_datetime").alias(TS)).groupBy(*on, TS).agg(F.count("*").alias(Y))
    return in_zones(per_zone, zones).select(*keys, TS, Y)


def merge_partials(*parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Adds stored partial counts; an hour missing on one side counts as zero."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.groupBy(*keys, TS).agg(F.sum(Y).alias(Y))


def audit(cube: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Raw rows, exclusive rejects and kept rows, per month of file or any cube column."""

    def counted(verdict: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("verdict") == verdict, F.col("n"))), F.lit(0)).cast("bigint")

    return cube.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("raw_rows"),
        counted("date").alias("rejected_date"),
        counted("values").alias("rejected_values"),
        counted("zone").alias("rejected_zone"),
        counted("kept").alias("kept_rows"),
    )


def observed_hours(cube: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Hours with at least one record inside the period, whatever the other rules say."""
    return cube.filter(F.col(TS).isNotNull()).select(*keys, TS).distinct()
