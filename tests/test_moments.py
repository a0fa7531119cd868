import numpy as np
import pytest
from helpers import KEYED, history, to_spark
from pyspark.sql import functions as F

from hourly_demand.operators import moments, windows
from hourly_demand.plans import models


def test_ridge_makes_its_rows_once_and_keeps_none(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(value):
        made.add(1)
        return value

    rows = spark.range(300).select((F.col("id") % 24).cast("int").alias("hour"), counted((F.col("id") % 5).cast("double")).alias("lag_1"), (F.col("id") % 7).cast("double").alias("trips_count"))
    monkeypatch.setattr(type(rows), "persist", lambda *_: pytest.fail("rows are kept"))
    model = models.fit_ridge(rows, ["hour", "lag_1"], 2.0)
    assert made.value == 300
    i = np.arange(300)
    z = i % 5 - 2.0
    x = np.column_stack([*(i % 24 == h for h in range(24)), z / z.std()]).astype(float)
    centred, y = x - x.mean(axis=0), i % 7
    w = np.linalg.solve(centred.T @ centred + 2.0 * np.eye(25), centred.T @ (y - y.mean()))
    np.testing.assert_allclose(model.stages[-2].coefficients.toArray(), w, atol=1e-10)


def test_moments_of_tasks_with_different_categories(spark):
    rows = spark.range(0, 400, 1, 7).select((F.col("id") / 100).cast("int").alias("c"), (F.col("id") % 11 + 1e6).alias("v"))
    found = moments.moments(rows, ["c"], ["v"])
    i = np.arange(400)
    x = np.column_stack([*(i // 100 == c for c in range(4)), i % 11 + 1e6]).astype(float)
    assert found.n == 400 and found.sizes == (4,) and (found.low[-1], found.high[-1]) == (1e6, 1e6 + 10)
    np.testing.assert_allclose(found.mean, x.mean(axis=0), rtol=1e-14)
    np.testing.assert_allclose(found.scatter, np.cov(x.T, bias=True) * 400, atol=1e-7)
    assert moments.moments(rows.limit(0), ["c"], ["v"]) is None


@pytest.mark.parametrize("wrong", ["null", "double('nan')", "double('inf')"])
def test_moments_refuse_missing_values(spark, wrong):
    rows = spark.range(20).select(F.expr(f"if(id = 7, {wrong}, double(id))").alias("v"))
    with pytest.raises(Exception, match="missing or infinite"):
        moments.moments(rows, [], ["v"])


def test_ridge_with_a_flat_label_and_column(spark):
    rows = spark.range(50).select(F.lit(3.0).alias("lag_1"), (F.col("id") % 4).cast("double").alias("lag_2"), F.lit(0.1).alias("trips_count"))
    model = models.fit_ridge(rows, ["lag_1", "lag_2"], 1.0)
    assert model.stages[-2].coefficients.toArray().tolist() == [0, 0]
    assert model.transform(rows).agg(F.max(F.abs(F.col("prediction") - 0.1))).first()[0] < 1e-12


def test_rolling_deviation_is_written_out_once(spark):
    panel = to_spark(spark, history().assign(zone_id=1)[["zone_id", "pickup_hour", "trips_count"]], KEYED)
    rolled = windows.rolling(panel, [168], 1, ["std"], ["zone_id"])
    # Days merged one by one repeated the earlier ones in each later one: some 600 differences of days.
    assert rolled._jdf.queryExecution().optimizedPlan().toString().count("_day.mean") < 40
    flat = windows.rolling(panel.withColumn("trips_count", F.lit(4.0)), [168], 1, ["std"], ["zone_id"])
    assert flat.where("roll_std_168 > 0").isEmpty() and flat.where("roll_std_168 = 0").count() == 300 - 168
