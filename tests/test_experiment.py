from datetime import timedelta

import pandas as pd
import pytest
from helpers import KEYED, to_spark, year_panel
from pyspark.sql import functions as F

from hourly_demand.config import Protocol, Span
from hourly_demand.plans import experiment
from hourly_demand.plans.forecast import forecast, load_model

PROTOCOL = Protocol(
    folds=(Span("a", "2024-02-05", "2024-02-09"), Span("b", "2024-02-09", "2024-02-13"), Span("c", "2024-02-13", "2024-02-17")),
    calibration=Span("cal", "2024-02-17", "2024-02-22"),
    periods=(Span("first", "2024-02-22", "2024-02-26"), Span("second", "2024-02-26", "2024-03-01")),
    inner_window=timedelta(days=4),
    trials=1,
)


@pytest.fixture(scope="module")
def panel(spark):
    return year_panel(spark, end="2024-03-01")


def test_exploration_tables(spark, panel):
    pdf, df = panel
    tables = experiment.explore(df, PROTOCOL.calibration.start)
    train = pdf[pdf.pickup_hour < "2024-02-17"]
    assert tables["target_statistics"].first()["mean"] == pytest.approx(train.trips_count.mean())
    top = tables["periodogram"].orderBy(F.desc("power")).first()
    assert top["period"] == pytest.approx(24, rel=0.03)
    assert tables["daily"].count() == 47 and tables["histogram"].agg(F.sum("n")).first()[0] == len(train)


def test_study_of_one_series(spark, panel, tmp_path):
    study = experiment.run(panel[1], PROTOCOL, str(tmp_path / "s"), rounds=3)
    board = study.table("leaderboard")
    assert board.count() == 7 and board.filter("selected").count() == 1
    cv = study.table("cv_folds")
    assert cv.groupBy("candidate").agg(F.countDistinct("fold").alias("n")).filter("n <> 3").count() == 0
    results = study.table("evaluation")
    assert {r["period"] for r in results.collect()} == {"first", "second"} and results.filter("MAE IS NULL").count() == 0
    assert results.select("candidate").distinct().count() == 3
    for name in ("error_segments", "findings", "correlations", "coefficients", "importance_groups", "importance_gain"):
        assert study.table(name).count() > 0
    assert spark.read.json(f"{study.out}/monitoring").count() == 2
    costs = experiment.scenario_costs(study, [("base", 3.0, 1.0)]).orderBy("period").collect()
    mine = results.filter(F.col("candidate") == study.champion).orderBy("period").collect()
    assert [c["BusinessLoss"] for c in costs] == pytest.approx([m["BusinessLoss"] for m in mine])
    history = panel[1].filter(F.col("pickup_hour") < F.lit("2024-02-26").cast("timestamp_ntz"))
    made = forecast(history, load_model(spark, f"{study.out}/model"), "2024-02-26", strict=True).first()
    first = study.table("predictions").filter(
        (F.col("candidate") == study.champion) & (F.col("pickup_hour") == F.lit("2024-02-26").cast("timestamp_ntz"))
    ).first()
    assert (made["prediction"], made["lower"]) == pytest.approx((first["prediction"], first["lower"]))


def test_study_of_several_series(spark, panel, tmp_path):
    pdf, _ = panel
    both = pd.concat([pdf.assign(zone_id=1), pdf.assign(zone_id=2, trips_count=pdf.trips_count / 2)])
    df = to_spark(spark, both[["zone_id", "pickup_hour", "trips_count"]], KEYED)
    study = experiment.run(df, PROTOCOL, str(tmp_path / "s"), ["zone_id"], families=["Ridge"])
    assert study.table("radii").count() == 2
    assert spark.read.json(f"{study.out}/monitoring").count() == 4
    history = df.filter(F.col("pickup_hour") < F.lit("2024-02-26").cast("timestamp_ntz"))
    made = forecast(history, load_model(spark, f"{study.out}/model"), "2024-02-26", ["zone_id"]).collect()
    assert {r["status"] for r in made} == {"ok"} and len(made) == 2
