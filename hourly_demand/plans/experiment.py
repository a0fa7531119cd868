"""A whole study of a panel: exploration, search, selection, hold-out evaluation and artefacts.

Every step stores its table below one folder, so later steps read a small stored result instead of
recomputing the plan behind it, and a lost run can be inspected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TS, Y, Protocol
from ..functions.time import ntz
from ..operators import drift, intervals, metrics, profile, ranks, selection, spectrum
from ..sources.writers import write_json, write_table
from . import backtest, features, importance, models, report
from .forecast import ForecastModel, save_model

NAIVE = "WeeklyNaive"
FAMILIES = ("Ridge", "Trees")


def explore(panel: DataFrame, end, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Exploratory tables of the hours before `end`, by name."""
    train = panel.filter(F.col(TS) < ntz(end))
    return {
        "target_statistics": profile.target_stats(train, keys, single_series=bool(keys)),
        "zero_missing": profile.zero_missing(train, keys),
        "extreme_hours": ranks.mad_outliers(train, Y, keys),
        "daily": profile.daily_resample(train, keys),
        "histogram": profile.histogram(train, Y, 50, keys),
        "profiles": profile.profiles(train, keys),
        "peak_trough": profile.peak_trough(train, keys),
        "autocorrelation": profile.autocorr(train, keys=keys),
        "periodogram": spectrum.periodogram(train, keys),
    }


def write_exploration(panel: DataFrame, end, out: str, keys: Sequence[str] = ()) -> None:
    for name, table in explore(panel, end, keys).items():
        write_table(table, f"{out}/{name}", "parquet")


@dataclass(frozen=True)
class Study:
    """Where the results are, and what was chosen."""

    out: str
    champion: str
    method: str
    spark: object

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/{name}")


class _Folder:
    """Stores tables and reads them back."""

    def __init__(self, spark, out: str):
        self.spark, self.out = spark, out

    def store(self, df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{self.out}/{name}", "parquet")
        return self.spark.read.parquet(f"{self.out}/{name}")


def _candidates(
    table: DataFrame, protocol: Protocol, families: Sequence[str], rounds: int, folder: _Folder
) -> list[models.ModelSpec]:
    """The baseline and, per family, the best trial with each feature set."""
    sets = features.feature_sets(protocol.delay)
    specs = [models.ModelSpec(NAIVE, NAIVE, tuple(sets["full"]))]
    for family in families:
        trials = models.search(table, family, sets["full"], protocol, rounds)
        folder.store(models.trials_frame(folder.spark, trials, family), f"search_{family}")
        specs += models.ablation_specs(family, models.best_trial(trials).params, sets)
    return specs


def _final_rounds(cv: DataFrame, name: str) -> int:
    return metrics.median_rounds(cv.filter(F.col("candidate") == name)).first()["rounds"]


def run(
    panel: DataFrame,
    protocol: Protocol,
    out: str,
    keys: Sequence[str] = (),
    families: Sequence[str] = FAMILIES,
    rounds: int | None = None,
) -> Study:
    """Runs the frozen protocol and stores all results below `out`.

    Models are pooled over the series and one champion is chosen for all of them. Intervals and
    monitoring are per series. The hold-out periods are read only after the choice is stored.
    """
    spark = panel.sparkSession
    folder = _Folder(spark, out)
    rounds = rounds or protocol.max_trees
    frozen = {k: str(v) for k, v in asdict(protocol).items()}
    write_json(spark.range(1).select(F.create_map(*[F.lit(x) for kv in frozen.items() for x in kv]).alias("protocol")), f"{out}/protocol")
    table = folder.store(features.complete_rows(features.features(panel, protocol.delay, keys)), "features")
    tune = table.filter(F.col(TS) < ntz(protocol.calibration.start))

    specs = _candidates(tune, protocol, families, rounds, folder)
    runs = {s.name: models.back_test(tune, s, protocol, rounds=rounds) for s in specs}
    cv = runs[NAIVE][0]
    for name, (rows, _) in runs.items():
        cv = cv if name == NAIVE else cv.unionByName(rows)
    cv = folder.store(cv, "cv_folds")
    board = folder.store(backtest.select(cv, protocol), "leaderboard")
    chosen = board.filter("selected").first()["candidate"]

    # One group per fold pools all series, so the pooled form is used for any number of them.
    per_fold = folder.store(backtest.pooled_interval_cv(runs[chosen][1], protocol), "interval_cv")
    choice = folder.store(backtest.interval_choice(per_fold, protocol), "interval_choice")
    method = choice.first()["method"]
    picked = selection.best_per_family(board, protocol.metric).select("candidate").collect()
    by_name = {s.name: s for s in specs}
    finalists = [by_name[r["candidate"]] for r in picked]
    write_json(spark.range(1).select(F.lit(chosen).alias("candidate"), F.lit(method).alias("method")), f"{out}/selection")

    fit, calibration, _ = backtest.final_slices(table, protocol)
    fitted, parts = {}, []
    for spec in finalists:
        n = _final_rounds(cv, spec.name) if spec.family == "Trees" else rounds
        fitted[spec.name], _ = spec.fit(fit, protocol, n)
        scored = spec.predictor(fitted[spec.name])(table.filter(F.col(TS) >= ntz(protocol.calibration.start)))
        parts.append(scored.withColumn("candidate", F.lit(spec.name)))
    base = [*keys, TS, Y, "hour", "weekday", "is_holiday", "candidate", "prediction"]
    predicted = parts[0].select(*base)
    for part in parts[1:]:
        predicted = predicted.unionByName(part.select(*base))
    pred = folder.store(backtest.final_predictions(predicted, protocol, method, keys), "predictions")
    results = folder.store(backtest.final_scores(pred, protocol), "evaluation")
    mine = pred.filter(F.col("candidate") == chosen)
    folder.store(metrics.error_segments(mine), "error_segments")
    folder.store(report.findings(board, results, protocol.alpha), "findings")
    # Correlations leave out the last fold, as the other exploratory tables do.
    explored = tune.filter(F.col(TS) < ntz(protocol.folds[-1].start))
    folder.store(profile.corr_matrix(explored, [Y, *features.feature_sets(protocol.delay)["full"]]), "correlations")

    reference = folder.store(drift.reference_distribution(fit, keys, single_series=bool(keys)), "reference")
    watched = drift.monitor(mine, reference, [*keys, "period"], keys, protocol.max_mae)
    write_json(watched, f"{out}/monitoring")
    _explain(by_name, fitted, calibration, keys, protocol, folder)

    spec = by_name[chosen]
    rows = spec.predictor(fitted[chosen])(calibration)
    radii = (
        intervals.series_radii(rows, protocol.alpha, keys, method, min_n=protocol.min_rows)
        if keys
        else intervals.conformal_radii(rows, protocol.alpha, methods=[method], min_n=protocol.min_rows).select("method", "q")
    )
    save_model(
        ForecastModel(
            spec.family if fitted[chosen] is None else chosen,
            ("lag_168",) if fitted[chosen] is None else spec.columns,
            folder.store(radii, "radii"),
            protocol.calibration.start.isoformat(),
            tuple(keys),
            protocol.delay,
            pipeline=fitted[chosen],
            reference=reference,
            settings={"alpha": protocol.alpha, "metric": protocol.metric},
        ),
        f"{out}/model",
    )
    return Study(out, chosen, method, spark)


def _explain(specs, fitted, calibration: DataFrame, keys, protocol: Protocol, folder: _Folder) -> None:
    """Importances on the calibration span; the hold-out periods stay untouched."""
    for name, model in fitted.items():
        if model is None:
            continue
        spec = specs[name]
        label = spec.family.lower()
        shuffled = importance.permutation_importance(
            calibration, model.transform, spec.columns, keys, seed=protocol.seed
        )
        folder.store(shuffled, f"importance_permutation_{label}")
        if spec.family == "Ridge":
            folder.store(importance.coefficients(model, calibration), "coefficients")
            continue
        shifted = importance.group_importance(calibration, model.transform, spec.columns, keys, seed=protocol.seed)
        folder.store(shifted, "importance_groups")
        if protocol.metric == "MAE":
            folder.store(importance.gain_importance(model, spec.columns, folder.spark), "importance_gain")


def scenario_costs(study: Study, scenarios) -> DataFrame:
    """Losses of the stored champion predictions under other penalties, per period."""
    mine = study.table("predictions").filter(F.col("candidate") == study.champion)
    return metrics.cost_scenarios(mine, scenarios, ["period"])
