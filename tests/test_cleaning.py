import glob
import os
import shutil
from dataclasses import replace
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourly_demand.config import Rules
from hourly_demand.operators import cleaning, panel
from hourly_demand.plans.build_panel import build, build_panel
from hourly_demand.sources import readers, refresh, writers

RULES = Rules("2024-01-01", "2024-02-01")
RAW = "tpep_pickup_datetime TIMESTAMP_NTZ, PULocationID BIGINT, trip_distance DOUBLE, total_amount DOUBLE"


def january(month="2024-01"):
    start = datetime.fromisoformat(f"{month}-01")
    n = {1: 744, 2: 696}[start.month]
    hours = pd.date_range(start, periods=n, freq="h")
    rows = [(h.to_pydatetime(), 1, 2.0, 10.0) for h in hours]
    bad = [
        (rows[0][0], 1, 0.0, 10.0),
        (rows[1][0], 1, 2.0, -1.0),
        (rows[2][0], 999, 2.0, 10.0),
        (datetime(2008, 1, 1), 1, 2.0, 10.0),
        (rows[4][0], 1, 150.0, 10.0),
    ]
    return rows + bad


def zone_set(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "zone_id BIGINT")


def trips(spark, rows):
    return readers.project_trips(spark.createDataFrame(rows, RAW))


def test_month_is_cleaned_with_exclusive_rejects(spark):
    made = build(trips(spark, january()), zone_set(spark, 1), RULES).persist()
    row = made.audit().first()
    assert row.asDict() == {
        "raw_rows": 749, "rejected_date": 1, "rejected_values": 3, "rejected_zone": 1, "kept_rows": 744,
    }
    assert made.check().panel().agg(F.sum("trips_count")).first()[0] == 744
    made.cube.unpersist()


def test_missing_and_infinite_values_fail_their_rule_in_order(spark):
    t, inf = datetime(2024, 1, 5, 3, 20), float("inf")
    rows = [
        (None, None, None, None),
        (t, None, None, 1.0),
        (t, 1, float("nan"), 1.0),
        (t, 1, inf, 1.0),
        (t, 1, 1.0, -inf),
        (t, None, 1.0, 1.0),
        (t, 1, 100.0, 500.0),
        (datetime(2024, 2, 1), 1, 1.0, 1.0),
    ]
    got = cleaning.classify(trips(spark, rows), RULES, zone_set(spark, 1, 1))
    counts = {r["verdict"]: r["count"] for r in got.groupBy("verdict").count().collect()}
    assert counts == {"date": 2, "values": 4, "zone": 1, "kept": 1}
    cube = cleaning.verdict_cube(trips(spark, rows), zone_set(spark, 1, 1), RULES)
    assert cleaning.audit(cube).first().asDict() == {
        "raw_rows": 8, "rejected_date": 2, "rejected_values": 4, "rejected_zone": 1, "kept_rows": 1,
    }
    assert cleaning.kept_counts(trips(spark, rows), zone_set(spark, 1, 1), RULES).count() == 1


def test_silent_hours_and_empty_months_are_errors(spark):
    rows = [r for r in january() if r[0] != datetime(2024, 1, 9, 5)]
    with pytest.raises(ValueError, match="2024, 1, 9, 5"):
        build(trips(spark, rows), zone_set(spark, 1), RULES).check()
    with pytest.raises(ValueError, match="no trip"):
        build(trips(spark, january()), zone_set(spark, 77), RULES).check()


def test_hour_with_only_rejected_trips_is_zero(spark):
    rows = [r if r[0] != datetime(2024, 1, 9, 5) else (r[0], 1, 500.0, 10.0) for r in january()]
    made = build(trips(spark, rows), zone_set(spark, 1), RULES).check()
    row = made.panel().filter(F.col("pickup_hour") == F.lit("2024-01-09 05:00:00").cast("timestamp_ntz")).first()
    assert row["trips_count"] == 0


def test_panel_of_sparse_zones_has_every_hour(spark):
    t = [datetime(2024, 1, 1), datetime(2024, 1, 31, 23, 59), datetime(2024, 1, 10, 7, 1), datetime(2024, 1, 10, 7, 2)]
    rows = [(t[0], 1, 1.0, 1.0), (t[1], 1, 1.0, 1.0), (t[2], 2, 1.0, 1.0), (t[3], 2, 1.0, 1.0)]
    got = build_panel(trips(spark, rows), zone_set(spark, 1, 2, 3), RULES, ["zone_id"]).toPandas()
    assert got.groupby("zone_id").size().to_dict() == {1: 744, 2: 744}
    assert not got.duplicated(["zone_id", "pickup_hour"]).any()
    assert got[got.trips_count > 0].trips_count.tolist().count(2.0) == 1
    listed = build_panel(trips(spark, rows), zone_set(spark, 1, 2, 3), RULES, ["zone_id"], zone_set(spark, 1, 2, 3))
    assert listed.count() == 3 * 744
    counts = cleaning.kept_counts(trips(spark, rows), zone_set(spark, 1, 2, 3), RULES, ["zone_id"])
    dense = panel.densify(counts, panel.hour_grid(counts, RULES.start, RULES.end, ["zone_id"]), ["zone_id"])
    assert sorted(map(tuple, dense.collect())) == sorted(map(tuple, got.itertuples(index=False)))


def test_filters_reach_the_scan(spark, tmp_path):
    spark.createDataFrame(january(), RAW).write.parquet(str(tmp_path / "t"))
    t = readers.read_trips(spark, str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = cleaning.kept_counts(t, zone_set(spark, 1), RULES)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(trip_distance" in pushed and "LessThan(tpep_pickup_datetime" in pushed


def test_missing_column_raises(spark):
    with pytest.raises(ValueError, match="total_amount"):
        readers.project_trips(spark.createDataFrame(january(), RAW).drop("total_amount"))


def test_refresh_opens_stale_files_only_and_drops_gone_months(spark, tmp_path):
    src, store, zones = str(tmp_path / "in"), str(tmp_path / "out"), zone_set(spark, 1)
    for month, rows in (("2024-01", "2024-01"), ("2024-02", "2024-02"), ("2024-03", "2024-02")):
        spark.createDataFrame(january(rows), RAW).coalesce(1).write.parquet(f"{src}/trips_{month}.parquet")
    run = lambda: [str(m)[:7] for m in refresh.refresh(spark, src, store, zones, Rules("2024-01-01", "2024-04-01"))]
    assert run() == ["2024-01", "2024-02", "2024-03"]
    # A sound month whose file would fail if it were opened: same name, size and time, no Parquet.
    (path,) = glob.glob(f"{src}/trips_2024-01.parquet/*.parquet")
    times, size = os.stat(path), os.path.getsize(path)
    open(path, "wb").write(b"x" * size)
    os.utime(path, ns=(times.st_atime_ns, times.st_mtime_ns))
    spark.createDataFrame(january("2024-02"), RAW).coalesce(1).write.mode("append").parquet(f"{src}/trips_2024-02.parquet")
    shutil.rmtree(f"{src}/trips_2024-03.parquet")
    assert run() == ["2024-02"]
    done = refresh.Store(spark, store)
    months = lambda df: sorted(str(r["file_month"])[:7] for r in df.select("file_month").distinct().collect())
    assert months(done.manifest()) == months(done.counts()) == ["2024-01", "2024-02"]
    assert run() == []


def test_store_recomputes_only_what_changed(spark, tmp_path):
    src, store, zones = str(tmp_path / "in"), str(tmp_path / "out"), zone_set(spark, 1)
    rules = Rules("2024-01-01", "2024-03-01")
    for month in ("2024-01", "2024-02"):
        path = f"{src}/trips_{month}.parquet"
        spark.createDataFrame(january(month), RAW).coalesce(1).write.parquet(path)
    run = lambda r=rules, z=zones: [str(m)[:7] for m in refresh.refresh(spark, src, store, z, r)]
    assert run() == ["2024-01", "2024-02"]
    assert run() == []
    rows = refresh.Store(spark, store).manifest().orderBy("file_month").collect()
    assert [(r["kept_rows"], r["rejected_date"], r["rejected_values"], r["rejected_zone"]) for r in rows] == [
        (744, 1, 3, 1), (696, 1, 3, 1),
    ]
    # More rows in one month, other rules, other zones.
    spark.createDataFrame(january("2024-02"), RAW).coalesce(1).write.mode("append").parquet(f"{src}/trips_2024-02.parquet")
    assert run() == ["2024-02"]
    assert run(replace(rules, max_distance=200.0)) == ["2024-01", "2024-02"]
    assert run() == ["2024-01", "2024-02"]
    assert run(rules, zone_set(spark, 1, 2)) == ["2024-01", "2024-02"]
    assert run() == ["2024-01", "2024-02"]
    # Stored counts that no longer agree with the manifest.
    counts = spark.read.parquet(f"{store}/counts/file_month=2024-01-01")
    spark.createDataFrame(counts.limit(700).collect(), counts.schema).write.mode("overwrite").parquet(
        f"{store}/counts/file_month=2024-01-01"
    )
    assert run() == ["2024-01"]
    for f in glob.glob(f"{store}/manifest/file_month=2024-02-01/*.parquet"):
        open(f, "wb").write(b"")
        spark.createDataFrame([], refresh.MANIFEST_SCHEMA).drop("file_month").coalesce(1).write.mode("overwrite").parquet(
            f"{store}/manifest/file_month=2024-02-01"
        )
    assert run() == ["2024-02"]


def test_month_of_the_file_limits_its_trips(spark, tmp_path):
    spark.createDataFrame(january(), RAW).write.parquet(str(tmp_path / "x_2024-02.parquet"))
    t = readers.read_months(spark, [str(tmp_path / "x_2024-02.parquet")])
    cube = cleaning.verdict_cube(t, zone_set(spark, 1), Rules("2024-01-01", "2024-03-01"))
    assert cleaning.audit(cube, ["file_month"]).first()["rejected_date"] == 749


def test_months_with_different_column_types(spark, tmp_path):
    a, b = str(tmp_path / "x_2024-01.parquet"), str(tmp_path / "x_2024-02.parquet")
    spark.createDataFrame(january(), RAW).write.parquet(a)
    feb = spark.createDataFrame(january("2024-02"), RAW)
    feb.withColumn("PULocationID", F.col("PULocationID").cast("double")).write.parquet(b)
    t = readers.read_months(spark, [a, b], drift=True)
    assert dict(t.dtypes)["zone_id"] == "bigint" and t.count() == 749 + 701


def test_text_columns_are_coerced(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "v STRING")
    assert [r[0] for r in cleaning.coerce(df, {"v": "double"}).collect()] == [1.5, None, None]


def test_zone_file(spark, tmp_path):
    (tmp_path / "z.csv").write_text('LocationID,Borough,Zone\n1,EWR,a\n2,Queens,"b, c"\n2,Queens,d\n3,Bronx,e\nx,Bronx,f\n')
    assert sorted(r[0] for r in readers.zones(spark, str(tmp_path / "z.csv")).collect()) == [2, 3]


def test_series_csv_is_strict(spark, tmp_path):
    (tmp_path / "ok.csv").write_text("pickup_hour,trips_count\n2024-01-01 00:00:00,5\n2024-01-01T01:00,6\n")
    got = readers.read_series_csv(spark, str(tmp_path / "ok.csv")).collect()
    assert [(str(r[0]), r[1]) for r in got] == [("2024-01-01 00:00:00", 5.0), ("2024-01-01 01:00:00", 6.0)]
    (tmp_path / "bad.csv").write_text("pickup_hour,trips_count\n2024-01-01 00:00:00,many\n")
    with pytest.raises(Exception):
        readers.read_series_csv(spark, str(tmp_path / "bad.csv")).collect()


def test_panel_write_replaces_only_its_months(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = lambda month, y: [(datetime(2024, month, 1, h), y) for h in range(24)]
    make = lambda r: spark.createDataFrame(r, "pickup_hour TIMESTAMP_NTZ, trips_count DOUBLE")
    writers.write_panel(make(rows(1, 1.0) + rows(2, 2.0)), path)
    writers.write_panel(make(rows(2, 5.0)), path)
    got = spark.read.parquet(path).groupBy("month").agg(F.sum("trips_count")).collect()
    assert {r[0]: r[1] for r in got} == {"2024-01": 24.0, "2024-02": 120.0}


def test_json_and_csv_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"], None)], "k STRING, alerts ARRAY<STRING>, v DOUBLE")
    writers.write_json(df, str(tmp_path / "j"))
    row = spark.read.json(str(tmp_path / "j")).first()
    assert row["alerts"] == ["x", "y"] and "v" in row.asDict()
    writers.write_table(df.drop("alerts"), str(tmp_path / "c"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["k", "v"]
    with pytest.raises(ValueError):
        writers.write_table(df, str(tmp_path / "x"), "xml")
