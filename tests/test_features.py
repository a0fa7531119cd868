import numpy as np
import pandas as pd
import pytest
from helpers import KEYED, PANEL, history, sorted_pandas, to_spark, year_panel
from pandas.tseries.holiday import USFederalHolidayCalendar
from pyspark.sql import functions as F

from hourly_demand.functions.calendar import holiday_flag
from hourly_demand.functions.time import is_dst_hour
from hourly_demand.operators import windows
from hourly_demand.operators.panel import dst_hours, hour_grid, null_dst
from hourly_demand.operators.validation import panel_violations
from hourly_demand.plans.features import complete_rows, feature_sets, features, series_status


def test_later_values_do_not_change_earlier_features(spark):
    base = history()
    changed = base.copy()
    changed.loc[200:, "trips_count"] += 10000
    a = sorted_pandas(features(to_spark(spark, base)), "pickup_hour").iloc[200].drop("trips_count")
    b = sorted_pandas(features(to_spark(spark, changed)), "pickup_hour").iloc[200].drop("trips_count")
    pd.testing.assert_series_equal(a, b)
    assert a.lag_168 == base.trips_count[32]
    assert a.roll_mean_24 == pytest.approx(base.trips_count[176:200].mean())


@pytest.mark.parametrize("delay", [1, 2, 24])
@pytest.mark.parametrize("chunk_hours", [50, 2016])
def test_features_match_pandas_whatever_the_chunks(spark, delay, chunk_hours):
    rng = np.random.default_rng(7)
    base = history(periods=500)
    base["trips_count"] = rng.poisson(30, 500).astype(float)
    base.loc[[40, 260], "trips_count"] = np.nan
    got = sorted_pandas(features(to_spark(spark, base), delay, chunk_hours=chunk_hours), "pickup_hour")
    for k in {delay, delay + 1, delay + 2, 24, 168}:
        np.testing.assert_array_equal(got[f"lag_{k}"], base.trips_count.shift(k))
    for w in (3, 24, 168):
        prior = base.trips_count.shift(delay).rolling(w, min_periods=w)
        np.testing.assert_allclose(got[f"roll_mean_{w}"], prior.mean(), rtol=1e-9)
        np.testing.assert_allclose(got[f"roll_std_{w}"], prior.std(ddof=0), rtol=1e-7, atol=1e-7)
    assert list(got.columns) == ["pickup_hour", "trips_count", *feature_sets(delay)["full"]]


def test_series_do_not_mix(spark):
    a, b = history(), history()
    b["trips_count"] *= 3
    both = pd.concat([a.assign(zone_id=1), b.assign(zone_id=2)])[["zone_id", "pickup_hour", "trips_count"]]
    got = features(to_spark(spark, both, KEYED), 1, ["zone_id"], chunk_hours=100)
    alone = sorted_pandas(features(to_spark(spark, b)), "pickup_hour")
    mine = sorted_pandas(got.filter("zone_id = 2").drop("zone_id"), "pickup_hour")
    pd.testing.assert_frame_equal(mine, alone)


def test_gap_gives_null_instead_of_a_shifted_value(spark):
    base = history().drop(250)
    got = sorted_pandas(features(to_spark(spark, base)), "pickup_hour")
    row = got[got.pickup_hour == history().pickup_hour[251]].iloc[0]
    assert np.isnan(row.lag_1) and np.isnan(row.roll_mean_3) and np.isnan(row.lag_168)


def test_year_has_the_expected_complete_rows(spark):
    _, panel = year_panel(spark)
    assert panel.count() == 9528
    for delay, rows in [(1, 9022), (2, 9021), (24, 8999)]:
        table = features(panel, delay)
        assert complete_rows(table).count() == table.dropna().count() == rows


def test_feature_sets_are_nested():
    sets = feature_sets(1)
    assert [len(sets[s]) for s in ("calendar", "lags", "full")] == [8, 13, 19]
    assert len(feature_sets(24)["lags"]) == 12
    with pytest.raises(ValueError):
        feature_sets(25)


def test_lag_by_join_equals_lag_by_window(spark):
    panel = to_spark(spark, history())
    a = sorted_pandas(windows.lags(panel, [1, 30], mode="join"), "pickup_hour")
    b = sorted_pandas(windows.lags(panel, [1, 30]), "pickup_hour")
    pd.testing.assert_frame_equal(a, b)


def test_holidays_match_the_public_calendar(spark):
    days = pd.date_range("1980-01-01", "2040-12-31", freq="D")
    df = spark.createDataFrame([(d.to_pydatetime(),) for d in days], "pickup_hour TIMESTAMP_NTZ")
    found = {r[0] for r in holiday_flag(df).filter("is_holiday = 1").select("pickup_hour").collect()}
    expected = {d.to_pydatetime() for d in USFederalHolidayCalendar().holidays("1980-01-01", "2040-12-31")}
    assert found == expected


@pytest.mark.parametrize("session_zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_clock_change_hours_do_not_depend_on_the_session(spark, session_zone):
    from datetime import datetime

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        grid = hour_grid(spark, datetime(2024, 1, 1), datetime(2025, 2, 1))
        assert grid.count() == 9528
        found = {str(r[0]) for r in dst_hours(grid, "America/New_York").collect()}
        assert found == {"2024-03-10 02:00:00", "2024-11-03 01:00:00"}
        panel = grid.withColumn("trips_count", F.lit(5))
        a = null_dst(panel, "America/New_York")
        b = null_dst(panel, "America/New_York", datetime(2024, 1, 1), datetime(2025, 2, 1))
        for p in (a, b):
            assert {str(r[0]) for r in p.filter("trips_count IS NULL").select("pickup_hour").collect()} == found
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dst_hours_match_pandas_in_another_zone(spark):
    hours = pd.date_range("2021-01-01", "2022-12-31 23:00", freq="h")
    df = spark.createDataFrame([(h.to_pydatetime(),) for h in hours], "pickup_hour TIMESTAMP_NTZ")
    found = {r[0] for r in df.filter(is_dst_hour("pickup_hour", "Europe/Berlin")).collect()}
    bad = hours[hours.tz_localize("Europe/Berlin", ambiguous="NaT", nonexistent="NaT").isna()]
    assert found == {h.to_pydatetime() for h in bad}


def test_schema_of_panel(spark):
    assert to_spark(spark, history(), PANEL).schema["pickup_hour"].dataType.simpleString() == "timestamp_ntz"


@pytest.mark.parametrize("chunk_hours", [2016, 50])
def test_deviations_survive_a_change_of_level(spark, chunk_hours):
    """Counts of 0 and then around 1e7, with an unknown hour: as exact as a fresh window."""
    rng = np.random.default_rng(4)
    y = np.concatenate([np.zeros(300), 1e7 + rng.integers(0, 2, 400), 1e7 + rng.random(300)])
    y[850] = np.nan
    pdf = pd.DataFrame({"pickup_hour": pd.date_range("2024-01-01 05:00", periods=len(y), freq="h"), "trips_count": y})
    got = windows.rolling(to_spark(spark, pdf), (3, 24, 25, 60, 168), 2, chunk_hours=chunk_hours).orderBy("pickup_hour").toPandas()
    for size in (3, 24, 25, 60, 168):
        for at in range(len(y)):
            part = y[at - size - 1 : at - 1] if at >= size + 1 else np.array([np.nan])
            found = got[f"roll_std_{size}"][at]
            if np.isnan(part).any():
                assert np.isnan(found), (size, at)
            else:
                assert found == pytest.approx(part.std(), rel=1e-7, abs=1e-9), (size, at)


@pytest.mark.parametrize("chunk_hours", [2016, 60])
def test_a_broken_series_yields_a_status(spark, chunk_hours):
    """The same violations as the panel contract counts, found beside the features; sound series keep theirs."""
    base, start = history(periods=900), history(periods=1).pickup_hour[0]
    at = lambda i: start + pd.Timedelta(hours=i)
    parts = {z: base.assign(zone_id=z) for z in (1, 2, 3, 4, 5, 6, 7)}
    parts[2] = parts[2].drop(index=range(300, 720))  # longer than any window looks back
    parts[3] = pd.concat([parts[3], parts[3].iloc[[5, 5, 400]]])
    parts[4].loc[10, "trips_count"] = -2.0
    parts[4].loc[11, "trips_count"] = float("inf")
    parts[5] = pd.concat([parts[5], pd.DataFrame({"pickup_hour": [pd.NaT, pd.NaT], "trips_count": [1.0, 2.0], "zone_id": [5, 5]})])
    parts[6] = pd.concat([parts[6], pd.DataFrame({"pickup_hour": [at(899) + pd.Timedelta(minutes=90)], "trips_count": [1.0], "zone_id": [6]})])
    parts[7].loc[20, "trips_count"] = np.nan  # a known gap is no violation
    df = to_spark(spark, pd.concat(parts.values())[["zone_id", "pickup_hour", "trips_count"]], KEYED).persist()
    table = features(df, 1, ["zone_id"], chunk_hours, checked=True).persist()
    assert table.count() == df.count()
    got = {r["zone_id"]: r for r in series_status(table, ["zone_id"]).collect()}
    assert {z: r["status"] for z, r in got.items()} == {1: "ok", 2: "invalid", 3: "invalid", 4: "invalid", 5: "invalid", 6: "invalid", 7: "ok"}
    want = {}
    for r in panel_violations(df, ["zone_id"], allow_null=True).collect():
        want.setdefault(r["zone_id"], {})[r["check"]] = r["n_bad"]
    names = {"null_time": "n_no_time", "off_hour": "n_off_hour", "duplicate_hour": "n_duplicate_hour", "missing_hour": "n_missing", "not_finite": "n_not_finite", "negative": "n_negative"}
    for z, r in got.items():
        assert {c: r[n] for c, n in names.items()} == {c: want[z][c] for c in names}, z
    sound = lambda t: t.filter("zone_id = 1").orderBy("pickup_hour").toPandas()
    plain = sound(features(df, 1, ["zone_id"], chunk_hours))
    pd.testing.assert_frame_equal(sound(table)[plain.columns], plain)
