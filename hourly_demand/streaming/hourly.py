"""Continuous hourly counts, reject audit, monitoring and forecasts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TS, Y, Rules, check_delay
from ..functions.time import from_hour_index, hour_index, ntz
from ..operators.cleaning import before_zone, in_period, in_zones, valid_values, with_zone_verdict
from ..operators.drift import monitor_merged, monitor_sums
from ..operators.groups import null_safe_anti, unbroadcast
from ..plans.forecast import HISTORY_HOURS, ForecastModel, forecast_hours
from ..sources.shared import checkpoint_root


def trip_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files: str | None = None, per_trigger: int | None = None
) -> DataFrame:
    """Trip files that arrive in a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(folder)


def _event_time(df: DataFrame, delay: int) -> DataFrame:
    """Watermarks need an instant, so the local time is read as if it were UTC.

    Rows later than the availability delay are dropped; the batch refresh picks them up.
    """
    t = F.col("pickup_datetime")
    instant = F.timestamp_seconds(hour_index(t) * 3600 + F.minute(t) * 60 + F.second(t))
    return df.withColumn("_at", instant).withWatermark("_at", f"{check_delay(delay)} hours")


def _local_hour() -> Column:
    """Start of the window as a local time again."""
    return from_hour_index(F.unix_seconds("window.start") / 3600)


def _counts(timed: DataFrame, delay: int, by: Sequence[str]) -> DataFrame:
    """Rows per hour and `by`, closed by the watermark: window, by, n."""
    return _event_time(timed, delay).groupBy(F.window("_at", "1 hour"), *by).agg(F.count("*").alias("n"))


def _summed(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Closed counts added up to fewer groups: a second aggregation behind the first one's watermark."""
    return counts.groupBy(F.window("window", "1 hour"), *by).agg(F.sum("n").alias("n"))


def stream_hourly(
    stream: DataFrame, rules: Rules, zones: DataFrame, delay: int = 1, keys: Sequence[str] = ()
) -> DataFrame:
    """Kept trips per series for each closed hour, in append mode.

    Trips are counted per zone before the zones are joined, so only counts meet the zone table.
    """
    by = list(dict.fromkeys(["zone_id", *keys]))
    counts = in_zones(_counts(stream.filter(in_period(stream, rules) & valid_values(rules)), delay, by), zones)
    if set(by) != set(keys):
        counts = _summed(counts, list(keys))
    return counts.select(*keys, _local_hour().alias(TS), F.col("n").alias(Y))


def stream_audit(stream: DataFrame, rules: Rules, zones: DataFrame, delay: int = 1) -> DataFrame:
    """Trips per verdict for each closed hour (verdict, hour, n); the sums of n are the raw trips.

    Date rejects, trips without a time among them, have no hour of the period. They pass by the
    watermark, one row each with a NULL hour, so a trip from a far future closes nothing.
    """
    marked = stream.withColumn("_before", before_zone(stream, rules))
    timed = _counts(marked.filter("_before <> 'date'"), delay, ["zone_id", "_before"])
    judged = with_zone_verdict(timed, zones).select("window", "verdict", "n")
    closed = _summed(judged, ["verdict"]).select("verdict", _local_hour().alias(TS), "n")
    rejected = marked.filter("_before = 'date'").select(
        F.col("_before").alias("verdict"), F.lit(None).cast("timestamp_ntz").alias(TS), F.lit(1).cast("bigint").alias("n")
    )
    return closed.unionByName(rejected)


def late_rows(batch_counts: DataFrame, stream_counts_: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Hours whose complete batch count differs from what the stream has emitted."""
    on = [*keys, TS]
    emitted = stream_counts_.select(*on, F.col(Y).alias("emitted"))
    joined = batch_counts.join(emitted, on, "left").withColumn("emitted", F.coalesce("emitted", F.lit(0)))
    late = F.col(Y) - F.col("emitted")
    return joined.withColumn("late", late).filter(F.col("late") != 0).select(*on, Y, "emitted", "late")


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Processes everything that is available and returns the written table."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def monitor_batch(
    reference: DataFrame,
    path: str,
    by: Sequence[str] = ("period",),
    ref_by: Sequence[str] = (),
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that stores what each micro-batch adds to the monitoring of its groups.

    Each batch owns the folder of its number, so a batch that is run again replaces its sums. The
    reference is stored once, with the first batch.
    """
    kept: list[DataFrame] = []

    def write(df: DataFrame, batch_id: int) -> None:
        if not kept:
            checkpoint_root(df.sparkSession)
            kept.append(reference.select(*ref_by, "edges", "probabilities").checkpoint())
        monitor_sums(df, kept[0], by, ref_by).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def merged_monitor(
    spark: SparkSession,
    path: str,
    reference: DataFrame,
    by: Sequence[str] = ("period",),
    ref_by: Sequence[str] = (),
    max_mae: float | None = None,
) -> DataFrame:
    """One monitoring row per group from the sums of all batches: as `monitor` on all their rows."""
    return monitor_merged(spark.read.parquet(path).drop("batch"), reference, by, ref_by, max_mae)


def stored_since(spark: SparkSession, path: str, month: str = "month") -> Callable[[datetime], DataFrame]:
    """Reader of a panel that is partitioned by month: hours from a time on, from the months that hold them."""

    def read(first: datetime) -> DataFrame:
        start = F.date_trunc("month", ntz(first)).cast("date")
        return spark.read.parquet(path).filter((F.col(month).cast("date") >= start) & (F.col(TS) >= ntz(first)))

    return read


def forecast_batch(
    panel: Callable[[datetime], DataFrame], model: ForecastModel, path: str, keys: Sequence[str] = ()
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that forecasts from every closed hour of each micro-batch.

    `panel` gives the stored panel from a time on; hours of the batch replace or extend it. A forecast
    sees the week up to its own hour only, however many later hours the batch holds.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        oldest = df.agg(F.min(TS).alias("t")).first()["t"]
        if oldest is None:
            return
        on = [*keys, TS]
        fresh = df.select(*on, F.col(Y).cast("double").alias(Y))
        stored = panel(oldest - timedelta(hours=HISTORY_HOURS)).select(*on, F.col(Y).cast("double").alias(Y))
        older = null_safe_anti(stored, unbroadcast(fresh.select(*on).distinct()), on)
        rows = forecast_hours(older.unionByName(fresh), fresh.select(*on).distinct(), model, keys)
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Runs a foreachBatch function on everything that is available."""
    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

