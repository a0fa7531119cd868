from dataclasses import replace
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from helpers import to_spark, year_panel
from pyspark.sql import functions as F

from hourly_demand.config import Protocol, Span
from hourly_demand.operators import drift, intervals, metrics, selection
from hourly_demand.plans import backtest, features as feat, importance, models, report
from hourly_demand.plans.forecast import ForecastModel, forecast, load_model, save_model

SETS = feat.feature_sets(1)
PROTOCOL = Protocol(
    folds=(Span("a", "2024-02-12", "2024-02-19"), Span("b", "2024-02-19", "2024-02-26")),
    calibration=Span("c", "2024-02-26", "2024-03-04"),
    periods=(Span("first", "2024-03-04", "2024-03-08"), Span("second", "2024-03-08", "2024-03-10")),
    inner_window=timedelta(days=7),
    trials=2,
)


@pytest.fixture(scope="module")
def table(spark):
    _, panel = year_panel(spark, end="2024-03-10")
    out = feat.complete_rows(feat.features(panel)).persist()
    out.count()
    return out


def test_ridge_equals_the_closed_form(spark, table):
    alpha = 25.0
    model = models.fit_ridge(table, SETS["full"], alpha)
    pdf = table.toPandas().sort_values("pickup_hour")
    numeric = [c for c in SETS["full"] if c not in ("hour", "weekday")]
    z = pdf[numeric].to_numpy(float)
    std = z.std(axis=0)
    z = (z - z.mean(axis=0)) / np.where(std == 0, 1, std)
    x = np.hstack([pd.get_dummies(pdf.hour).to_numpy(float), pd.get_dummies(pdf.weekday).to_numpy(float), z])
    y = pdf.trips_count.to_numpy()
    xc = x - x.mean(axis=0)
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ (y - y.mean()))
    expected = y.mean() + xc @ w
    got = model.transform(table).orderBy("pickup_hour").select("prediction").toPandas().prediction
    np.testing.assert_allclose(got, expected, rtol=1e-6)
    coef = {r["feature"]: r["coefficient"] for r in importance.coefficients(model, table).collect()}
    assert len(coef) == 24 + 7 + len(numeric)
    assert coef["z_lag_24"] == pytest.approx(w[31 + numeric.index("lag_24")], rel=1e-5)


def test_unknown_category_is_all_zero(spark, table):
    model = models.fit_ridge(table.filter("hour < 20"), ["hour", "lag_24"], 1.0)
    late = model.transform(table.filter("hour = 23").limit(1)).first()
    assert late["onehot_hour"].numNonzeros() == 0 and late["prediction"] is not None


def test_predictions_are_never_negative(spark):
    df = spark.createDataFrame([(float(i), float(max(0, 5 - i))) for i in range(50)], "lag_1 DOUBLE, trips_count DOUBLE")
    model = models.fit_ridge(df, ["lag_1"], 0.1)
    rows = model.transform(df).agg(F.min("prediction"), F.min("raw_prediction")).first()
    assert rows[0] == 0 and rows[1] < 0


def test_quantile_boosting_reaches_its_quantile(spark, table):
    tau = 0.75
    pinball = lambda df: df.agg(
        F.avg(F.greatest(tau * (F.col("trips_count") - F.col("prediction")), (tau - 1) * (F.col("trips_count") - F.col("prediction"))))
    ).first()[0]
    few, _ = models.fit_quantile(table, ["lag_24", "hour"], tau, stages=1, learning_rate=0.3, params={"maxDepth": 4})
    many, n = models.fit_quantile(table, ["lag_24", "hour"], tau, stages=8, learning_rate=0.3, params={"maxDepth": 4})
    assert n == 8
    fitted = many.transform(table)
    assert pinball(fitted) < 0.8 * pinball(few.transform(table))
    below = fitted.agg(F.avg((F.col("trips_count") <= F.col("prediction")).cast("double"))).first()[0]
    assert 0.68 < below < 0.85
    with pytest.raises(ValueError):
        models.fit_quantile(table, ["lag_24"], 1.0)


def test_quantile_model_can_be_stored(spark, table, tmp_path):
    model, _ = models.fit_quantile(table, ["lag_24", "hour"], 0.75, stages=2, params={"maxDepth": 2})
    model.write().overwrite().save(str(tmp_path / "q"))
    from pyspark.ml import PipelineModel

    again = PipelineModel.load(str(tmp_path / "q"))
    a = model.transform(table).agg(F.sum("prediction")).first()[0]
    assert again.transform(table).agg(F.sum("prediction")).first()[0] == pytest.approx(a)


def test_early_stopping_finds_a_number_of_rounds(spark, table):
    rows = backtest.fold_roles(table, replace(PROTOCOL, folds=PROTOCOL.folds[:1]))
    core, early = rows.filter("is_core"), rows.filter("is_early")
    model, best = models.fit_gbt(rows.filter("is_fit"), ["hour", "lag_24"], {"maxDepth": 2}, early, core, rounds=4)
    assert 1 <= best <= 4
    assert model.stages[1].getNumTrees == best
    gain = importance.gain_importance(model, ["hour", "lag_24"], spark).agg(F.sum("gain")).first()[0]
    assert gain == pytest.approx(1.0)


def test_folds_keep_their_order_and_embargo(spark, table):
    for delay in (1, 24):
        p = replace(PROTOCOL, delay=delay)
        rows = backtest.fold_roles(table, p)
        for f in p.folds:
            r = rows.filter(F.col("fold") == f.name).agg(
                *[F.max(F.when(F.col(c), F.col("pickup_hour"))).alias(c) for c in ("is_fit", "is_core", "is_early", "is_calibration")],
                F.min(F.when(F.col("is_valid"), F.col("pickup_hour"))).alias("valid"),
                F.min(F.when(F.col("is_calibration"), F.col("pickup_hour"))).alias("calibration"),
            ).first()
            hour = timedelta(hours=1)
            assert r["valid"] == f.start and r["is_calibration"] == f.start - hour
            assert r["calibration"] == f.start - p.inner_window
            assert r["is_early"] == r["calibration"] - hour
            assert r["is_fit"] == r["calibration"] - hour - timedelta(hours=delay - 1)
            assert r["is_core"] == r["calibration"] - p.inner_window - hour - timedelta(hours=delay - 1)
        train = backtest.assign_folds(table, p.folds).filter("role = 'train'").groupBy("fold").agg(F.max("pickup_hour").alias("t"))
        assert {r["fold"]: r["t"] for r in train.collect()} == {f.name: f.start - hour for f in p.folds}
    assert backtest.inner_split(table, PROTOCOL).filter("ok").count() == 2
    tiny = replace(PROTOCOL, folds=(Span("x", "2024-01-16", "2024-01-18"),))
    assert backtest.inner_split(table, tiny).filter("ok").count() == 0


def test_pooled_and_series_intervals_agree_for_one_series(spark, table):
    roles = backtest.fold_roles(
        backtest.with_candidates(table, [backtest.weekly_naive_candidate(19)]).select("pickup_hour", "trips_count", "candidate", "prediction"),
        PROTOCOL,
    )
    order = ["candidate", "fold", "method"]
    a = backtest.interval_cv(roles, PROTOCOL).toPandas().sort_values(order).reset_index(drop=True)
    b = backtest.pooled_interval_cv(roles, PROTOCOL).toPandas().sort_values(order).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b[a.columns])


def test_whole_experiment(spark, table, tmp_path):
    """Search, ablation, selection, final fit, report, monitoring and a stored forecast."""
    trials = models.search(table, "Ridge", SETS["full"], PROTOCOL)
    assert [t.number for t in trials] == [0, 1] and len({t.params["alpha"] for t in trials}) == 2
    again = models.search(table, "Ridge", SETS["full"], PROTOCOL, parallelism=1)
    assert [t.params for t in trials] == [t.params for t in again]
    best = models.best_trial(trials)
    specs = [models.ModelSpec("WeeklyNaive", "WeeklyNaive", tuple(SETS["full"]))]
    specs += models.ablation_specs("Ridge", best.params, SETS)
    runs = {s.name: models.back_test(table, s, PROTOCOL) for s in specs}
    cv = None
    for rows, _ in runs.values():
        cv = rows if cv is None else cv.unionByName(rows)
    assert metrics.check_cv(cv, 2).filter("not ok").count() == 0
    naive = backtest.evaluate(table, [backtest.weekly_naive_candidate(19)], PROTOCOL).orderBy("fold").toPandas()
    mine = runs["WeeklyNaive"][0].orderBy("fold").toPandas()
    pd.testing.assert_frame_equal(naive, mine[naive.columns], check_dtype=False)

    board = backtest.select(cv, PROTOCOL).checkpoint()
    chosen = [r["candidate"] for r in board.filter("selected").collect()]
    assert len(chosen) == 1
    spec = next(s for s in specs if s.name == chosen[0])
    choice = backtest.interval_choice(backtest.interval_cv(runs[spec.name][1], PROTOCOL), PROTOCOL)
    assert choice.count() == 1

    fit, calibration, tests = backtest.final_slices(table, PROTOCOL)
    fitted, _ = spec.fit(fit, PROTOCOL)
    both = table.withColumn("candidate", F.lit("WeeklyNaive")).withColumn("prediction", F.col("lag_168")).select(
        "pickup_hour", "trips_count", "hour", "weekday", "is_holiday", "candidate", "prediction"
    )
    if spec.name != "WeeklyNaive":
        scored = spec.predictor(fitted)(table).withColumn("candidate", F.lit(spec.name))
        both = both.unionByName(scored.select(*both.columns))
    pred = backtest.final_predictions(both, PROTOCOL, choice).checkpoint()
    results = backtest.final_scores(pred, PROTOCOL)
    assert {r["period"] for r in results.collect()} == {"first", "second"}
    assert results.filter("MAE IS NULL").count() == 0
    found = report.findings(board, results, PROTOCOL.alpha)
    assert {r["section"] for r in found.select("section").distinct().collect()} == {"champion", "period", "ablation"}
    ref = drift.reference_distribution(fit)
    watched = drift.monitor(pred.filter(F.col("candidate") == spec.name), ref)
    assert watched.count() == 2

    radii = intervals.conformal_radii(
        spec.predictor(fitted)(calibration), PROTOCOL.alpha, methods=[choice.first()["method"]]
    ).select("method", "q")
    model = ForecastModel(spec.name, spec.columns, radii, "2024-02-26", pipeline=fitted, reference=ref)
    save_model(model, str(tmp_path / "model"))
    history = table.select("pickup_hour", "trips_count").filter(F.col("pickup_hour") < F.lit("2024-03-08").cast("timestamp_ntz"))
    a = forecast(history, model, "2024-03-08", strict=True).first()
    b = forecast(history, load_model(spark, str(tmp_path / "model")), "2024-03-08", strict=True).first()
    assert a == b and a["lower"] <= a["prediction"] <= a["upper"]
    if spec.name != "WeeklyNaive":
        same = pred.filter((F.col("candidate") == spec.name) & (F.col("pickup_hour") == F.lit("2024-03-08").cast("timestamp_ntz"))).first()
        assert a["prediction"] == pytest.approx(same["prediction"])


def test_asymmetric_metric_uses_the_quantile_model(spark, table):
    p = replace(PROTOCOL, metric="BusinessLossPerHour", folds=PROTOCOL.folds[:1])
    spec = models.ModelSpec("Trees_lags", "Trees", ("hour", "lag_24"), {"maxDepth": 3})
    cv, _ = models.back_test(table, spec, p, rounds=3)
    assert 1 <= cv.first()["best_iteration"] <= 3 and cv.first()["BusinessLossPerHour"] > 0
    assert p.tau == 0.75


def test_importance_finds_the_used_feature(spark, table):
    predict = lambda df: df.withColumn("prediction", F.col("lag_24").cast("double"))
    cols = ["lag_24", "roll_mean_3", "hour"]
    got = {r["feature"]: r for r in importance.permutation_importance(table, predict, cols).collect()}
    assert got["lag_24"]["mae_increase"] > 5 and got["roll_mean_3"]["mae_increase"] == got["hour"]["mae_increase"] == 0
    groups = {r["group"]: r["mae_increase"] for r in importance.group_importance(table, predict, cols).collect()}
    assert set(groups) == {"lags", "rolling", "calendar"} and groups["rolling"] == 0 and groups["lags"] > 1


def test_group_shift_equals_numpy(spark, table):
    predict = lambda df: df.withColumn("prediction", 0.7 * F.col("lag_24") + 0.3 * F.col("lag_168"))
    got = importance.group_importance(table, predict, ["lag_24", "lag_168"], shifts=[31]).first()
    pdf = table.toPandas().sort_values("pickup_hour").reset_index(drop=True)

    def increase(pdf):
        order = np.roll(np.arange(len(pdf)), 31)
        plain = (pdf.trips_count - (0.7 * pdf.lag_24 + 0.3 * pdf.lag_168)).abs().mean()
        moved = pdf[["lag_24", "lag_168"]].to_numpy()[order]
        return np.abs(pdf.trips_count - moved @ [0.7, 0.3]).mean() - plain

    assert got["mae_increase"] == pytest.approx(increase(pdf))
    sampled = importance.group_importance(table, predict, ["lag_24", "lag_168"], shifts=[31], target_n=400).first()
    assert sampled["mae_increase"] == pytest.approx(increase(pdf.iloc[:: max(1, len(pdf) // 400)].reset_index(drop=True)))


def test_short_folds_have_a_status_and_no_champion(spark, table):
    cands = [backtest.weekly_naive_candidate(19), backtest.Candidate("Mean_full", "Mean", 19, "roll_mean_24")]
    start = table.agg(F.min("pickup_hour").alias("t")).first()["t"]
    young = table.filter(F.col("pickup_hour") >= F.lit(PROTOCOL.folds[0].start - timedelta(days=7, hours=20)))
    without = table.filter((F.col("pickup_hour") < F.lit(PROTOCOL.folds[1].start)) & (F.col("pickup_hour") >= F.lit(start)))
    rows = [part.withColumn("zone_id", F.lit(z)) for z, part in enumerate((table, young, without))]
    cv = backtest.evaluate(rows[0].unionByName(rows[1]).unionByName(rows[2]), cands, PROTOCOL, ["zone_id"]).persist()
    status = {(r["zone_id"], r["fold"]): (r["status"], r["MAE"] is None) for r in cv.filter("candidate = 'Mean_full'").collect()}
    assert status == {(0, "a"): ("ok", False), (0, "b"): ("ok", False), (1, "a"): ("short_fit", True), (1, "b"): ("ok", False), (2, "a"): ("ok", False), (2, "b"): ("no_validation", True)}
    board = backtest.select(cv, PROTOCOL, ["zone_id"]).collect()
    assert {r["zone_id"] for r in board if r["selected"]} == {0}
    assert all((r["MAE_mean"] is None) == (r["n_short"] > 0) and (r["n_short"] > 0) == (r["zone_id"] > 0) for r in board)
    # A fold that a series has no rows of at all counts as short too.
    missing = backtest.select(cv.filter("zone_id = 0 AND fold = 'a'"), PROTOCOL, ["zone_id"]).collect()
    assert {(r["n_folds"], r["n_short"], r["selected"]) for r in missing} == {(1, 1, False)}


def test_error_segments_match_pandas(spark, table):
    pred = table.withColumns(
        {"prediction": F.col("lag_24"), "lower": F.col("lag_24") - 20, "upper": F.col("lag_24") + 20, "period": F.lit("p")}
    )
    got = metrics.error_segments(metrics.with_errors(pred)).toPandas()
    pdf = pred.toPandas()
    pdf["e"] = (pdf.trips_count - pdf.prediction).abs()
    for dim in ("hour", "weekday", "is_holiday"):
        mine = got[got.dimension == dim].set_index("value").MAE.sort_index()
        np.testing.assert_allclose(mine, pdf.groupby(dim).e.mean())
    assert selection.METRICS == ("MAE", "BusinessLossPerHour")


def test_spark_frames_from_pandas_keep_missing_values(spark):
    df = to_spark(spark, pd.DataFrame({"pickup_hour": [pd.Timestamp("2024-01-01")], "trips_count": [np.nan]}))
    assert df.first()["trips_count"] is None
