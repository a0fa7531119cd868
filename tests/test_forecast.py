from dataclasses import replace
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from helpers import KEYED, PANEL, history, sorted_pandas, to_spark
from pyspark.sql import functions as F

from hourly_demand.config import Protocol, Rules, Span
from hourly_demand.operators import intervals, metrics, selection, validation
from hourly_demand.plans.forecast import forecast, load_model, naive_model, save_model


def radius(spark, q=10.0, method="absolute"):
    return spark.createDataFrame([(method, q)], "method STRING, q DOUBLE")


def model(spark, delay=1):
    return naive_model(radius(spark), "2024-01-01", delay)


@pytest.mark.parametrize("fault", ["gap", "duplicate", "negative", "null", "nan", "infinity", "offgrid", "extra", "zone"])
def test_faulty_panels_are_named(spark, fault):
    base = history()
    schema, name = PANEL, None
    if fault == "gap":
        base, name = base.drop(100), "missing_hour"
    if fault == "duplicate":
        base, name = pd.concat([base, base.iloc[[0]]]), "duplicate_hour"
    if fault == "negative":
        base.loc[10, "trips_count"], name = -1, "negative"
    if fault in ("null", "nan"):
        base.loc[10, "trips_count"], name = np.nan, "null_value"
    if fault == "infinity":
        base.loc[10, "trips_count"], name = np.inf, "not_finite"
    if fault == "offgrid":
        base.loc[10, "pickup_hour"] += pd.Timedelta(minutes=1)
        name = "off_hour"
    df = to_spark(spark, base, schema)
    if fault == "nan":
        df = df.withColumn("trips_count", F.coalesce("trips_count", F.lit(float("nan"))))
    if fault == "extra":
        df, name = df.withColumn("surprise", F.lit(0)), "columns"
    if fault == "zone":
        df, name = df.withColumn("pickup_hour", F.col("pickup_hour").cast("timestamp")), "TIMESTAMP_NTZ"
    with pytest.raises(ValueError, match=name):
        validation.validate_panel(df)


def test_valid_panels_pass(spark):
    assert validation.validate_panel(to_spark(spark, history())).count() == 300
    holes = history()
    holes.loc[5, "trips_count"] = np.nan
    validation.validate_panel(to_spark(spark, holes), allow_null=True)
    with pytest.raises(ValueError, match="no rows"):
        validation.validate_panel(spark.createDataFrame([], PANEL))


@pytest.mark.parametrize("delay", [1, 2, 24])
def test_forecast_is_the_value_a_week_before(spark, delay):
    base = history()
    target = base.pickup_hour.max() + pd.Timedelta(hours=delay)
    row = forecast(to_spark(spark, base), model(spark, delay), target.to_pydatetime(), strict=True).first()
    expected = base.set_index("pickup_hour").trips_count[target - pd.Timedelta(hours=168)]
    assert (row["prediction"], row["lower"], row["upper"]) == (expected, expected - 10, expected + 10)


def test_stale_future_and_live(spark):
    base, m = to_spark(spark, history()), model(spark)
    for target in ("2024-02-02T01:00:00", "2024-02-01T23:00:00"):
        with pytest.raises(ValueError, match="stale"):
            forecast(base, m, target, strict=True)
    with pytest.raises(ValueError, match="current"):
        forecast(base, m, "2024-02-02", live=True, as_of="2026-01-01T00:00:00-05:00")
    ok = forecast(base, m, "2024-02-02", live=True, as_of="2024-02-02T05:40:00+00:00").first()
    assert ok["status"] == "ok"
    with pytest.raises(ValueError, match="time zone"):
        forecast(base, m, "2024-02-02", live=True, as_of="2024-02-02T05:40:00")
    with pytest.raises(ValueError, match="start of a local hour"):
        forecast(base, m, "2024-02-02T00:30:00")


def test_clock_changes_and_short_histories(spark):
    spring = to_spark(spark, history(end="2024-03-11 23:00"))
    with pytest.raises(ValueError, match="dst"):
        forecast(spring, model(spark), "2024-03-12", strict=True)
    short = to_spark(spark, history(periods=167))
    with pytest.raises(ValueError, match="short"):
        forecast(short, model(spark), "2024-02-02", strict=True)
    gap = to_spark(spark, history().drop(250))
    with pytest.raises(ValueError, match="invalid"):
        forecast(gap, model(spark), "2024-02-02", strict=True)


def test_each_series_has_its_own_status_and_radius(spark):
    parts = [
        history().assign(zone_id=1),
        history(end="2024-02-01 22:00").assign(zone_id=2),
        history(periods=100).assign(zone_id=3),
        pd.concat([history(), history().iloc[[299]]]).assign(zone_id=4),
    ]
    df = to_spark(spark, pd.concat(parts)[["zone_id", "pickup_hour", "trips_count"]], KEYED)
    radii = spark.createDataFrame([(i, "scaled", float(i)) for i in range(1, 5)], "zone_id BIGINT, method STRING, q DOUBLE")
    got = sorted_pandas(forecast(df, naive_model(radii, "2024-01-01", 1, ["zone_id"]), "2024-02-02", ["zone_id"]), "zone_id")
    assert got.status.tolist() == ["ok", "stale", "short", "invalid"]
    p = history().trips_count[132]
    assert got.loc[0, "prediction"] == p and got.loc[0, "upper"] == pytest.approx(p + np.sqrt(p))
    assert got.prediction.isna().tolist() == [False, True, True, True]


def test_model_round_trip_and_version(spark, tmp_path):
    base = to_spark(spark, history())
    m = replace(model(spark), settings={"alpha": 0.1})
    save_model(m, str(tmp_path / "m"))
    again = load_model(spark, str(tmp_path / "m"))
    assert again.settings == m.settings and again.columns == m.columns
    assert forecast(base, again, "2024-02-02").collect() == forecast(base, m, "2024-02-02").collect()
    save_model(replace(m, schema_version=0), str(tmp_path / "old"))
    with pytest.raises(ValueError, match="version"):
        load_model(spark, str(tmp_path / "old"))


def test_loss_and_scores_by_hand(spark):
    df = spark.createDataFrame([(10.0, 8.0), (10.0, 13.0)], "trips_count DOUBLE, prediction DOUBLE")
    row = metrics.business_loss(df).first()
    assert (row["BusinessLoss"], row["BusinessLossPerHour"]) == (9.0, 4.5)
    zeros = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "trips_count DOUBLE, prediction DOUBLE")
    row = metrics.metrics(zeros).first()
    assert row["WAPE_pct"] is None and row["MAE"] == 1.5
    bad = df.union(spark.createDataFrame([(float("nan"), 1.0)], df.schema))
    row = metrics.metrics(bad).first()
    assert row["n_bad"] == 1 and row["MAE"] is None


def test_scenarios_equal_the_direct_loss(spark):
    df = spark.createDataFrame([(10.0, 8.0), (10.0, 13.0), (4.0, 4.5)], "trips_count DOUBLE, prediction DOUBLE")
    got = {r["scenario"]: r["BusinessLoss"] for r in metrics.cost_scenarios(df, [("a", 3, 1), ("b", 1, 7)]).collect()}
    for name, under, over in [("a", 3.0, 1.0), ("b", 1.0, 7.0)]:
        assert got[name] == pytest.approx(metrics.business_loss(df, under, over).first()["BusinessLoss"])
    with pytest.raises(ValueError):
        metrics.cost_scenarios(df, [("bad", 0, 1)])


def test_interval_by_hand(spark):
    rows = [(float(i + 20), float(i + 18)) for i in range(100)]
    df = spark.createDataFrame(rows, "trips_count DOUBLE, prediction DOUBLE")
    q = intervals.conformal_radius(df).first()["q"]
    assert q == 2
    got = intervals.bounds(df, q).toPandas()
    assert (got.upper == got.trips_count).all() and (got.lower >= 0).all()
    assert intervals.conformal_radius(df.limit(1)).first()["reason"] == "too_few"
    assert intervals.series_radii(df).first()["q"] == 2
    scaled = intervals.conformal_radius(df, "scaled").first()["q"]
    scores = np.sort(2 / np.sqrt(np.maximum(1, np.arange(100) + 18)))
    assert scaled == pytest.approx(scores[int(np.ceil(101 * 0.9)) - 1])


def test_champion_prefers_simplicity_within_one_percent(spark):
    rows = [
        ("A_full", "A", 10.0, 1.0, 19),
        ("A_lags", "A", 10.05, 0.5, 13),
        ("B_lags", "B", 10.1, 0.4, 13),
        ("B_calendar", "B", 10.1001 + 1e-3, 0.1, 8),
    ]
    board = spark.createDataFrame(rows, "candidate STRING, family STRING, MAE_mean DOUBLE, MAE_std DOUBLE, n_features INT")
    got = selection.champion(board)
    assert [r["candidate"] for r in got.filter("selected").collect()] == ["B_lags"]
    best = {r["family"]: r["candidate"] for r in selection.best_per_family(got).collect()}
    assert best == {"A": "A_full", "B": "B_lags"}
    late = board.withColumn("inference_median_s", F.when(F.col("candidate") == "B_lags", 2.0).otherwise(1.0))
    tie = late.withColumn("MAE_std", F.lit(0.5))
    assert [r["candidate"] for r in selection.champion(tie).filter("selected").collect()] == ["A_lags"]


def test_interval_method_choice(spark):
    rows = [("absolute", 0.93, 10.0), ("scaled", 0.87, 9.0)]
    summary = spark.createDataFrame(rows, "method STRING, coverage DOUBLE, mean_width DOUBLE")
    assert selection.choose_interval(summary.withColumn("coverage", F.lit(0.9))).first()["method"] == "scaled"
    assert selection.choose_interval(summary.withColumn("mean_width", F.lit(9.0)), 0.08).first()["method"] == "absolute"


@pytest.mark.parametrize(
    "bad",
    [{"delay": 0}, {"delay": 25}, {"alpha": 0.0}, {"alpha": 1.0}, {"trials": 0}, {"max_trees": 0},
     {"cost_under": 0.0}, {"cost_over": -1.0}, {"metric": "R2"}, {"folds": ()}],
)
def test_parameters_are_checked_before_any_job(bad):
    with pytest.raises(ValueError):
        replace(Protocol.for_year(2024), **bad)


def test_protocol_of_a_year():
    p = Protocol.for_year(2024, include_new_test=False)
    assert [f.name for f in p.folds] == ["2024-08", "2024-09", "2024-10"]
    assert p.calibration.start == datetime(2024, 11, 1) and p.periods[-1].end == datetime(2025, 1, 1)
    assert Protocol.for_year(2024).tau == 0.75
    with pytest.raises(ValueError):
        Rules("2024-01-02", "2024-01-01")
    with pytest.raises(ValueError):
        Span("x", datetime(2024, 1, 1).astimezone(), "2024-02-01")
