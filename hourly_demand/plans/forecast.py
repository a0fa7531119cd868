"""Stored models and next-hour forecasts for every series at once."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import timedelta
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import TS, Y, check_delay
from ..functions.time import floor_hour, hour_index, ntz
from ..operators.groups import attach, null_safe_join, unbroadcast
from ..operators.intervals import apply_radius
from ..operators.panel import task_count
from ..operators.validation import history_status, live_check, target_hour, week_status
from ..sources.writers import write_json
from .features import features

SCHEMA_VERSION = 1
HISTORY_HOURS = 168
#: Column of the newest hour that a forecast of `forecast_hours` sees.
CLOSED = "closed_hour"
#: Column of the time since the start of the hour, which is zero for hours on the clock.
PAST = "past_hour"


@dataclass(frozen=True)
class ForecastModel:
    """A fitted model with what is needed to forecast and to monitor it.

    `radii` has the columns (keys, method, q), one row per series or a single row; `reference` is
    the reference distribution of the fit rows. Without a pipeline the model is the weekly-naive one.
    """

    name: str
    columns: tuple[str, ...]
    radii: DataFrame
    fitted_until: str
    keys: tuple[str, ...] = ()
    delay: int = 1
    zone: str = "America/New_York"
    pipeline: PipelineModel | None = None
    reference: DataFrame | None = None
    settings: dict = field(default_factory=dict)
    schema_version: int = SCHEMA_VERSION

    def __post_init__(self):
        check_delay(self.delay)

    def predict(self, table: DataFrame) -> DataFrame:
        """Adds `prediction`."""
        if self.pipeline is None:
            return table.withColumn("prediction", F.col("lag_168").cast("double"))
        return self.pipeline.transform(table)


def save_model(model: ForecastModel, path: str) -> None:
    spark = model.radii.sparkSession
    meta = {
        "schema_version": model.schema_version,
        "name": model.name,
        "columns": list(model.columns),
        "fitted_until": model.fitted_until,
        "keys": list(model.keys),
        "delay": model.delay,
        "zone": model.zone,
        "has_pipeline": model.pipeline is not None,
        "has_reference": model.reference is not None,
        "settings": model.settings,
    }
    model.radii.write.mode("overwrite").parquet(f"{path}/radii")
    if model.reference is not None:
        model.reference.write.mode("overwrite").parquet(f"{path}/reference")
    if model.pipeline is not None:
        model.pipeline.write().overwrite().save(f"{path}/pipeline")
    row = spark.range(1).select(F.lit(model.schema_version).alias("schema_version"), F.lit(json.dumps(meta)).alias("meta"))
    write_json(row, f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> ForecastModel:
    """The stored model; another schema version is refused."""
    row = spark.read.schema("schema_version INT, meta STRING").json(f"{path}/meta").first()
    if row is None or row["schema_version"] != SCHEMA_VERSION:
        raise ValueError("incompatible model version")
    meta = json.loads(row["meta"])
    return ForecastModel(
        name=meta["name"],
        columns=tuple(meta["columns"]),
        radii=spark.read.parquet(f"{path}/radii"),
        fitted_until=meta["fitted_until"],
        keys=tuple(meta["keys"]),
        delay=meta["delay"],
        zone=meta["zone"],
        pipeline=PipelineModel.load(f"{path}/pipeline") if meta["has_pipeline"] else None,
        reference=spark.read.parquet(f"{path}/reference") if meta["has_reference"] else None,
        settings=meta["settings"],
    )


def padded_history(history: DataFrame, target, delay: int, keys: Sequence[str] = ()) -> DataFrame:
    """The last week before the newest usable hour, and empty rows up to the target."""
    target = target_hour(target)
    last = target - timedelta(hours=delay)
    tail = history.filter(F.col(TS) > ntz(last - timedelta(hours=HISTORY_HOURS))).filter(F.col(TS) <= ntz(last))
    # The newest row also emits the empty hours, so the history is read once.
    onward = F.sequence(ntz(last), ntz(target), F.expr("INTERVAL '1' HOUR"))
    hours = F.when(F.col(TS) == ntz(last), onward).otherwise(F.array(TS))
    spread = tail.withColumn("_hour", F.explode(hours))
    y = F.when(F.col("_hour") == F.col(TS), F.col(Y).cast("double"))
    return spread.select(*keys, F.col("_hour").alias(TS), y.alias(Y))


def forecast(
    history: DataFrame,
    model: ForecastModel,
    target,
    keys: Sequence[str] = (),
    live: bool = False,
    as_of=None,
    strict: bool = False,
) -> DataFrame:
    """Prediction and bounds of the target hour per series, with the status of its history.

    Series whose history is not usable keep a row without a forecast; series without a radius keep
    their prediction, without bounds, and the status no_radius. `strict` raises for unusable histories.
    `live` also demands that the target is the current local hour at `as_of`.
    """
    spark = history.sparkSession
    if live and not live_check(spark, target, as_of, model.zone).first()["ok"]:
        raise ValueError("the target is not the current local hour")
    status = history_status(history, target, model.delay, keys, model.zone, HISTORY_HOURS)
    status = status.select(*keys, "status")
    if strict:
        bad = [r["status"] for r in status.filter("status <> 'ok'").select("status").distinct().collect()]
        if bad:
            raise ValueError(f"history not usable: {sorted(bad)}")
    # Every series is predicted and the unusable ones are blanked, so the status is computed once.
    table = features(padded_history(history, target, model.delay, keys), model.delay, keys)
    row = table.filter(F.col(TS) == ntz(target_hour(target))).dropna(subset=["lag_168", *model.columns])
    # A series with doubled hours has more than one such row; its status blanks it below.
    row = row.dropDuplicates(list(keys) or [TS])
    return _answered(status, row, model, keys, ntz(target_hour(target)), keys)


def _answered(status: DataFrame, rows: DataFrame, model: ForecastModel, keys: Sequence[str], target: Column, by: Sequence[str]) -> DataFrame:
    """Forecasts of the target rows, one per row of status; `by` are the columns that both share."""
    predicted = apply_radius(model.predict(rows), model.radii, model.keys, "left")
    made = predicted.select(*by, "prediction", "lower", "upper")
    usable = F.col("status") == "ok"
    bare = usable & F.col("prediction").isNotNull() & F.col("lower").isNull()
    return attach(status, unbroadcast(made), by, "left").select(
        *keys,
        target.alias(TS),
        *[F.when(usable, F.col(c)).alias(c) for c in ("prediction", "lower", "upper")],
        F.when(bare, "no_radius").otherwise(F.col("status")).alias("status"),
    )


def forecast_hours(history: DataFrame, closed: DataFrame, model: ForecastModel, keys: Sequence[str] = ()) -> DataFrame:
    """A forecast from each closed hour of each series, all in one pass. Runs a job that counts their hours.

    closed: keys and hour. The target lies the delay after its closed hour. A forecast sees the week up to its closed
    hour only, and its row is the same as `forecast` on that week gives: lags and windows look back from the target by
    the delay at least and by that week at most, so the weeks of a series share their hours, each held once.
    """
    hour = F.expr("INTERVAL '1' HOUR")
    last = F.col(CLOSED)
    wanted = closed.select(*keys, F.col(TS).alias(CLOSED)).distinct()
    # Weeks meet their hours by equality: hours off the clock make a series of their own.
    series = [*keys, PAST]
    shared = _shared_weeks(history, wanted, model, keys, series)
    status = attach(wanted, unbroadcast(week_status(shared, series, TS, model.delay, model.zone, HISTORY_HOURS).select(*keys, F.col(TS).alias(CLOSED), "status")), [*keys, CLOSED], "left")
    status = status.withColumn("status", F.coalesce("status", F.lit("stale")))
    table = features(shared.select(*series, TS, Y), model.delay, series).drop(PAST)
    targets = wanted.withColumn(TS, last + model.delay * hour)
    rows = null_safe_join(targets, unbroadcast(table), [*keys, TS]).withColumn(Y, F.lit(None).cast("double")).dropna(subset=["lag_168", *model.columns])
    return _answered(status, rows, model, keys, last + model.delay * hour, [*keys, CLOSED])


def _shared_weeks(history: DataFrame, wanted: DataFrame, model: ForecastModel, keys: Sequence[str], series: Sequence[str]) -> DataFrame:
    """Every hour of the weeks up to the wanted hours, and up to their targets, once: `series`, hour, target, and

    `_rows` of the history, `_bad` of them, and whether the hour is wanted (`_closed`). Values that break the contract
    are NULL: no usable week holds them, and sums do not carry them on to the weeks after.
    """
    hour, past = F.expr("INTERVAL '1' HOUR"), lambda c: (F.col(c) - floor_hour(c)).alias(PAST)
    timed = wanted.filter(F.col(CLOSED).isNotNull()).select(*keys, past(CLOSED), CLOSED)
    # Each week adds the hours that the week before it does not have.
    before = F.lag(CLOSED).over(Window.partitionBy(*series).orderBy(CLOSED))
    first = F.greatest(F.col(CLOSED) - (HISTORY_HOURS - 1) * hour, before + (model.delay + 1) * hour)
    spans = timed.withColumn("_first", first).withColumn("_to", F.col(CLOSED) + model.delay * hour)
    total = spans.agg(F.sum(hour_index("_to") - hour_index("_first") + 1)).first()[0] or 0
    y = F.col(Y).cast("double")
    sound = y.isNotNull() & ~F.isnan(y) & (F.abs(y) != float("inf")) & (y >= 0)
    none = F.lit(0).cast("bigint")
    parts = [
        spans.select(*series, F.explode(F.sequence("_first", "_to", hour)).alias(TS), F.lit(True).alias("_in"), F.lit(False).alias("_closed"), none.alias("_rows"), none.alias("_bad"), F.lit(None).cast("double").alias(Y)),
        timed.select(*series, F.col(CLOSED).alias(TS), F.lit(True), F.lit(True), none, none, F.lit(None).cast("double")),
        history.filter(F.col(TS).isNotNull()).select(*keys, past(TS), TS, F.lit(False), F.lit(False), none + 1, (~sound).cast("bigint"), F.when(sound, y)),
    ]
    rows = reduce(DataFrame.union, parts).repartition(task_count(history.sparkSession, total), *series)
    each = rows.groupBy(*series, TS).agg(F.max("_in").alias("_in"), F.max("_closed").alias("_closed"), F.sum("_rows").alias("_rows"), F.sum("_bad").alias("_bad"), F.max(Y).alias(Y))
    return each.filter("_in").drop("_in")


def naive_model(
    radii: DataFrame, fitted_until: str, delay: int = 1, keys: Sequence[str] = (), reference: DataFrame | None = None
) -> ForecastModel:
    return ForecastModel("WeeklyNaive", ("lag_168",), radii, fitted_until, tuple(keys), delay, reference=reference)
