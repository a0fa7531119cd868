from datetime import datetime, timedelta

import pandas as pd
import pytest
from helpers import KEYED, history, to_spark
from pyspark.sql import functions as F

from hourly_demand.config import Rules
from hourly_demand.operators import cleaning, drift
from hourly_demand.plans.forecast import forecast, naive_model
from hourly_demand.streaming import hourly

RULES = Rules("2024-01-01", "2024-02-01")
SCHEMA = "pickup_datetime TIMESTAMP_NTZ, zone_id BIGINT, trip_distance DOUBLE, total_amount DOUBLE"


def zone_set(spark):
    return spark.createDataFrame([(1,), (2,)], "zone_id BIGINT")


def rows_of(day, n=200, zone=1):
    start = datetime(2024, 1, day)
    return [(start + timedelta(minutes=7 * i), zone, 1.0 if i % 10 else 0.0, 5.0) for i in range(n)]


def write(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def stream(spark, folder):
    reader = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1)
    return reader.parquet(folder)


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_stream_equals_batch_for_closed_hours(spark, tmp_path, session_zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        src = str(tmp_path / "in")
        for day in (2, 3, 4):
            write(spark, src, f"d{day}", rows_of(day) + rows_of(day, 150, 2) + rows_of(day, 20, 99))
        trips = stream(spark, src)
        out = hourly.run_to_table(
            hourly.stream_hourly(trips, RULES, zone_set(spark), 1, ["zone_id"]), str(tmp_path / "o"), str(tmp_path / "c")
        )
        got = {(r["zone_id"], r["pickup_hour"]): r["trips_count"] for r in out.collect()}
        batch = cleaning.kept_counts(spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(src), zone_set(spark), RULES, ["zone_id"])
        truth = {(r["zone_id"], r["pickup_hour"]): r["trips_count"] for r in batch.collect()}
        newest = max(t for _, t in truth)
        assert got == {k: v for k, v in truth.items() if k in got}
        # Only hours within the watermark of the newest record are still open.
        assert all(k[1] >= newest - timedelta(hours=2) for k in set(truth) - set(got))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_late_trips_are_left_to_the_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    write(spark, src, "a", rows_of(2))
    out = lambda: hourly.run_to_table(
        hourly.stream_hourly(stream(spark, src), RULES, zone_set(spark), 1), str(tmp_path / "o"), str(tmp_path / "c")
    )
    out()
    write(spark, src, "b", rows_of(5))
    out()
    write(spark, src, "c", [(datetime(2024, 1, 2, 3, 5), 1, 1.0, 5.0)])
    write(spark, src, "d", rows_of(9))
    emitted = out()
    trips = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(src)
    late = hourly.late_rows(cleaning.kept_counts(trips, zone_set(spark), RULES), emitted).collect()
    closed = [r for r in late if r["pickup_hour"] < datetime(2024, 1, 9)]
    assert [(r["pickup_hour"], r["late"]) for r in closed] == [(datetime(2024, 1, 2, 3), 1)]


def test_stream_and_batch_audits_add_up_to_the_raw_rows(spark, tmp_path):
    src = str(tmp_path / "in")
    # Trips without a time, and one from a far future that must not close any hour.
    odd = [(None, 1, 1.0, 5.0), (None, None, None, None), (datetime(2031, 5, 1), 1, 1.0, 5.0)]
    write(spark, src, "a", odd + rows_of(2) + rows_of(2, 30, 99))
    write(spark, src, "b", rows_of(3, 40) + [(datetime(2024, 1, 3, 1), None, 1.0, 5.0)] + odd[:1])
    write(spark, src, "c", rows_of(6, 1))
    out = hourly.run_to_table(hourly.stream_audit(stream(spark, src), RULES, zone_set(spark), 1), str(tmp_path / "o"), str(tmp_path / "c"))
    got = {(r["verdict"], r["pickup_hour"]): r["n"] for r in out.groupBy("verdict", "pickup_hour").agg(F.sum("n").alias("n")).collect()}
    trips = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(src)
    cube = cleaning.verdict_cube(trips, zone_set(spark), RULES).groupBy("verdict", "pickup_hour").agg(F.sum("n").alias("n"))
    want = {(r["verdict"], r["pickup_hour"]): r["n"] for r in cube.collect()}
    still_open = {k: n for k, n in want.items() if k[1] is not None and k[1] >= datetime(2024, 1, 6)}
    assert got == {k: n for k, n in want.items() if k not in still_open}
    assert sum(got.values()) + sum(still_open.values()) == trips.count()
    assert got[("date", None)] == 4


def test_city_counts_of_a_stream(spark, tmp_path):
    """Without keys the counts of the zones are added up behind the first aggregation."""
    src = str(tmp_path / "in")
    for day in (2, 3):
        write(spark, src, f"d{day}", rows_of(day) + rows_of(day, 150, 2) + rows_of(day, 20, 99))
    out = hourly.run_to_table(hourly.stream_hourly(stream(spark, src), RULES, zone_set(spark), 1), str(tmp_path / "o"), str(tmp_path / "c"))
    batch = cleaning.kept_counts(spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(src), zone_set(spark), RULES)
    truth = {}
    for r in batch.collect():
        truth[r["pickup_hour"]] = truth.get(r["pickup_hour"], 0) + r["trips_count"]
    got = {r["pickup_hour"]: r["trips_count"] for r in out.collect()}
    assert got == {t: n for t, n in truth.items() if t in got} and len(got) >= len(truth) - 3


def test_monitoring_across_micro_batches(spark, tmp_path):
    """A period that several batches share has one row, as if all its predictions had come at once."""
    ref = drift.reference_distribution(spark.range(1000).select(F.col("id").cast("double").alias("trips_count")))
    schema = "period STRING, trips_count DOUBLE, prediction DOUBLE, covered BOOLEAN"
    for i, base in enumerate((0, 300, 2000)):
        rows = [(f"p{(v + i) % 2}", float(base + 10 * v), float(base), None if v % 7 == 0 else v % 3 > 0) for v in range(100)]
        rows += [("bad", float("nan"), 1.0, None), ("q", 5.0, None, True)] if i == 1 else []
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    files = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    write_batch = hourly.monitor_batch(ref, str(tmp_path / "out"))
    hourly.run_batches(source, write_batch, str(tmp_path / "state"))

    def same():
        got = hourly.merged_monitor(spark, str(tmp_path / "out"), ref, max_mae=300.0).orderBy("period").toPandas()
        want = drift.monitor(files, ref, max_mae=300.0).orderBy("period").toPandas()
        assert got.period.tolist() == ["bad", "p0", "p1", "q"]
        for c in ("n", "n_bad"):
            assert got[c].tolist() == want[c].tolist()
        for c in ("psi", "MAE", "RMSE", "WAPE_pct", "coverage"):
            assert got[c].tolist() == pytest.approx(want[c].tolist(), nan_ok=True)
        assert [list(a) for a in got.alerts] == [list(a) for a in want.alerts]

    same()
    # A batch that is run again replaces its own sums.
    write_batch(spark.read.schema(schema).parquet(str(tmp_path / "in" / "0")), 0)
    numbers = {r["batch"] for r in spark.read.parquet(str(tmp_path / "out")).select("batch").distinct().collect()}
    assert numbers == {0, 1, 2}


def test_every_closed_hour_is_forecast(spark, tmp_path):
    """Stream equals batch with several hours a batch, a gap, a short series, and hours that replace stored ones."""
    frames = []
    for zone, (start, periods) in {1: (0, 300), 2: (150, 150), 3: (0, 299)}.items():
        part = history(periods=300).iloc[start : start + periods].assign(zone_id=zone)
        part["trips_count"] = part.trips_count * zone + zone
        frames.append(part)
    frames[2] = frames[2].drop(index=[200])
    panel = to_spark(spark, pd.concat(frames)[["zone_id", "pickup_hour", "trips_count"]], KEYED).persist()
    times = history(periods=300).pickup_hour
    cut, first_new = times[294].to_pydatetime(), times[292].to_pydatetime()
    root = str(tmp_path / "stored")
    old = panel.filter(F.col("pickup_hour") < F.lit(cut)).withColumn("trips_count", F.when(F.col("pickup_hour") >= F.lit(first_new), -1.0).otherwise(F.col("trips_count")))
    old.withColumn("month", F.date_trunc("month", "pickup_hour").cast("date")).write.partitionBy("month").parquet(root)
    model = naive_model(spark.createDataFrame([(1, "absolute", 3.0), (3, "absolute", 1.0)], "zone_id BIGINT, method STRING, q DOUBLE"), "2024-01-01", 1, ["zone_id"])
    fresh = panel.filter(F.col("pickup_hour") >= F.lit(first_new))
    write_batch = hourly.forecast_batch(hourly.stored_since(spark, root), model, str(tmp_path / "out"), ["zone_id"])
    write_batch(fresh, 0)
    got = {(r["zone_id"], r["pickup_hour"]): r[2:6] for r in spark.read.parquet(str(tmp_path / "out")).drop("batch").collect()}
    assert len(got) == fresh.count()
    for last in {r["pickup_hour"] for r in fresh.collect()}:
        week = panel.filter((F.col("pickup_hour") <= F.lit(last)) & (F.col("pickup_hour") > F.lit(last - timedelta(hours=168))))
        for r in forecast(week, model, last + timedelta(hours=1), ["zone_id"]).collect():
            key = (r["zone_id"], r["pickup_hour"])
            if key in got:
                assert got[key] == r[2:6], key
            else:
                assert r["status"] in ("stale", "invalid")  # its last hours are not among the closed ones
    assert {s[3] for s in got.values()} == {"ok", "invalid", "short"}
    write_batch(fresh.limit(0), 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == fresh.count()
