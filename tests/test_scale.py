"""Plans stay within a task's and the driver's memory, whatever Spark estimates."""

from dataclasses import replace
from datetime import datetime, timedelta

import pandas as pd
import pytest
from helpers import KEYED, history, to_spark
from pyspark.sql import functions as F

from hourly_demand.operators import windows
from hourly_demand.operators import panel as panels
from hourly_demand.plans import forecast

KEYS = ["zone_id"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hourly_panel(spark, zones=3):
    grid = panels.hour_grid(spark.range(zones).select(F.col("id").alias("zone_id")), datetime(2024, 1, 1), datetime(2024, 1, 11), KEYS)
    return grid.withColumn("trips_count", (F.col("zone_id") + F.hour("pickup_hour")).cast("double"))


def test_joined_lags_do_not_broadcast_a_panel(spark):
    panel = hourly_panel(spark)
    joined = windows.lags(panel, [1, 24], KEYS, mode="join")
    assert "BroadcastHashJoin" not in plan_of(joined)
    columns = ["zone_id", "pickup_hour", "trips_count", "lag_1", "lag_24"]
    assert sorted(map(str, joined.select(columns).collect())) == sorted(map(str, windows.lags(panel, [1, 24], KEYS).select(columns).collect()))


def test_forecasts_of_many_hours_do_not_broadcast_frames(spark, tmp_path):
    to_spark(spark, history().assign(zone_id=1)[["zone_id", "pickup_hour", "trips_count"]], KEYED).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    # One row per series, which may be broadcast; kept from it here, so that any broadcast is one of frames.
    radii = spark.createDataFrame([(1, "absolute", 2.0)], "zone_id BIGINT, method STRING, q DOUBLE").hint("merge")
    closed = rows.filter(F.col("pickup_hour") >= F.lit("2024-02-01 20:00:00").cast("timestamp_ntz"))
    made = forecast.forecast_hours(rows, closed, forecast.naive_model(radii, "2024-01-23", 1, KEYS), KEYS)
    assert "BroadcastHashJoin" not in plan_of(made)
    assert [r["status"] for r in made.collect()] == ["ok"] * 4


@pytest.fixture
def small_tasks(spark, monkeypatch):
    """Few hours a task; joins shuffle both sides, whose small partitions Spark would merge."""
    monkeypatch.setattr(panels, "ROWS_PER_TASK", 500, raising=False)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_hours_of_a_task_are_bounded(spark, small_tasks):
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 31)
    counts = spark.range(40).select(F.col("id").alias("zone_id"), F.lit(start).cast("timestamp_ntz").alias("pickup_hour"), F.lit(3).alias("trips_count"))
    known = counts.join(spark.range(40).select(F.col("id").alias("zone_id")), "zone_id", "left_semi")
    panel = panels.fill_hours(known, start, end, KEYS)
    # 28,800 hours in tasks of 500 and at least one series each.
    assert panel.rdd.getNumPartitions() >= 55
    assert panel.count() == 40 * 720 and panel.agg(F.sum("trips_count")).first()[0] == 120


def test_interpolated_hours_of_a_task_are_bounded(spark, small_tasks):
    filled = windows.interpolate_linear(hourly_panel(spark, 40).withColumn("trips_count", F.when(F.hour("pickup_hour") != 5, 7.0)), KEYS, chunk_hours=24)
    assert filled.rdd.getNumPartitions() >= 19
    assert filled.count() == 40 * 240 and filled.filter("filled = 7").count() == 40 * 240


def test_weeks_of_a_series_share_their_hours(spark):
    keyed = history().assign(zone_id=1)[["zone_id", "pickup_hour", "trips_count"]]
    keyed["trips_count"] = keyed.trips_count.astype(float)
    hours = keyed.pickup_hour
    closed = [t.to_pydatetime() for t in hours.iloc[-24:]]
    oldest = hours.iloc[-24 - 167]  # in the week of the first closed hour only
    parts = []
    for zone, change in enumerate(("none", "inf", "nan", "twice", "negative", "gone", "last")):
        part = keyed.assign(zone_id=zone)
        at = part.pickup_hour == (hours.iloc[-1] if change == "last" else oldest)
        part.loc[at, "trips_count"] = {"inf": float("inf"), "nan": float("nan"), "negative": -1.0, "last": -1.0}.get(change, 7.0)
        parts += [part[~at] if change == "gone" else part] + ([part[at]] if change == "twice" else [])
    rows = to_spark(spark, pd.concat(parts), KEYED)
    radii = spark.createDataFrame([(z, "absolute", 2.0) for z in range(7)], "zone_id BIGINT, method STRING, q DOUBLE")
    model = replace(forecast.naive_model(radii, "2024-01-23", 1, KEYS), columns=("lag_168", "roll_mean_168", "roll_std_168"))
    wanted = rows.select("zone_id", "pickup_hour").filter(F.col("pickup_hour").isin([F.lit(t) for t in closed])).distinct()
    shared = forecast._shared_weeks(rows, wanted.withColumnRenamed("pickup_hour", forecast.CLOSED), model, KEYS, [*KEYS, forecast.PAST])
    assert shared.count() == 7 * (168 + 24) and shared.filter("_closed").count() == 7 * 24
    made = {(r["zone_id"], r["pickup_hour"]): r[2:6] for r in forecast.forecast_hours(rows, wanted, model, KEYS).collect()}
    assert len(made) == 7 * 24
    for last in (closed[0], closed[1], closed[-1]):
        week = rows.filter((F.col("pickup_hour") <= F.lit(last)) & (F.col("pickup_hour") > F.lit(last - timedelta(hours=168))))
        for r in forecast.forecast(week, model, last + timedelta(hours=1), KEYS).collect():
            assert made[r["zone_id"], r["pickup_hour"]] == r[2:6]
    status = [[made[z, t + timedelta(hours=1)][3] for t in closed] for z in range(7)]
    assert status[0] == ["ok"] * 24 and status[6] == ["ok"] * 23 + ["invalid"]
    assert status[1:5] == [["invalid"] + ["ok"] * 23] * 4 and status[5] == ["short"] + ["ok"] * 23
