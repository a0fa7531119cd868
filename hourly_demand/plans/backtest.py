"""Calendar back-tests with embargo, interval choice and final evaluation.

Folds and periods are configuration, so rows are assigned by a literal array and a filter instead
of a range join. All candidates given as expressions are scored in one pass over the table, for
every series at once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TS, Y, Protocol, Span
from ..functions.errors import METHODS
from ..functions.time import in_span, ntz
from ..operators.groups import attach, exploded_literals
from ..operators.intervals import apply_radius, bounds, conformal_radii, with_series_radius
from ..operators.metrics import SCORES, interval_scores, interval_summary, leaderboard, score_columns, with_errors
from ..operators.selection import champion, choose_interval

ROLES = ("is_fit", "is_core", "is_early", "is_calibration", "is_valid")


@dataclass(frozen=True)
class Candidate:
    """A forecast that is an expression over the feature table."""

    name: str
    family: str
    n_features: int
    expression: str | Column

    def column(self) -> Column:
        return F.expr(self.expression) if isinstance(self.expression, str) else self.expression


def weekly_naive_candidate(n_features: int) -> Candidate:
    return Candidate("WeeklyNaive", "WeeklyNaive", n_features, "lag_168")


def assign_folds(table: DataFrame, folds: Sequence[Span]) -> DataFrame:
    """Each row once per fold that uses it: `train` before the fold, `valid` inside."""
    spans = exploded_literals([{"fold": f.name, "start": ntz(f.start), "end": ntz(f.end)} for f in folds])
    out = table.withColumn("_f", F.explode(spans)).filter(F.col(TS) < F.col("_f.end"))
    role = F.when(F.col(TS) < F.col("_f.start"), "train").otherwise("valid")
    return out.select(*table.columns, F.col("_f.fold").alias("fold"), role.alias("role"))


def assign_periods(table: DataFrame, periods: Sequence[Span]) -> DataFrame:
    """Each row once per named period it falls into."""
    spans = exploded_literals([{"period": p.name, "start": ntz(p.start), "end": ntz(p.end)} for p in periods])
    inside = (F.col(TS) >= F.col("_p.start")) & (F.col(TS) < F.col("_p.end"))
    out = table.withColumn("_p", F.explode(spans)).filter(inside)
    return out.select(*table.columns, F.col("_p.period").alias("period"))


def fold_roles(table: DataFrame, protocol: Protocol) -> DataFrame:
    """Each row once per fold with its part in it.

    The calibration window ends at the fold, the early-stopping window ends at the calibration
    window. The embargo shortens the fit and core parts at their upper end only.
    """
    rows = []
    for f in protocol.folds:
        calibration = f.start - protocol.inner_window
        early = calibration - protocol.inner_window
        rows.append(
            {
                "fold": f.name,
                "core_end": ntz(early - protocol.embargo),
                "early": ntz(early),
                "fit_end": ntz(calibration - protocol.embargo),
                "calibration": ntz(calibration),
                "start": ntz(f.start),
                "end": ntz(f.end),
            }
        )
    out = table.withColumn("_f", F.explode(exploded_literals(rows))).filter(F.col(TS) < F.col("_f.end"))
    t, f = F.col(TS), F.col("_f")
    return out.select(
        *table.columns,
        f["fold"].alias("fold"),
        (t < f["fit_end"]).alias("is_fit"),
        (t < f["core_end"]).alias("is_core"),
        ((t >= f["early"]) & (t < f["calibration"])).alias("is_early"),
        ((t >= f["calibration"]) & (t < f["start"])).alias("is_calibration"),
        (t >= f["start"]).alias("is_valid"),
    )


def inner_split(table: DataFrame, protocol: Protocol, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of each part per fold, and whether fit, calibration and validation are large enough."""
    out = fold_roles(table, protocol).groupBy(*keys, "fold").agg(
        *[F.count_if(F.col(r)).alias(r.replace("is_", "n_")) for r in ROLES]
    )
    enough = (F.col("n_fit") >= protocol.min_rows) & (F.col("n_calibration") >= protocol.min_rows)
    return out.withColumn("ok", enough & (F.col("n_valid") > 0))


def with_candidates(table: DataFrame, candidates: Sequence[Candidate]) -> DataFrame:
    """Each row once per candidate with its prediction, not below zero."""
    rows = [
        {
            "candidate": c.name,
            "family": c.family,
            "n_features": c.n_features,
            "prediction": F.greatest(F.lit(0.0), c.column().cast("double")),
        }
        for c in candidates
    ]
    kept = [c for c in table.columns if c not in rows[0]]
    return table.select(*kept, F.inline(exploded_literals(rows)))


def cv_rows(predicted: DataFrame, protocol: Protocol, keys: Sequence[str] = ()) -> DataFrame:
    """One row per series, candidate and fold: sizes, status, train MAE and validation scores.

    A fold whose fit or calibration part has fewer than `min_rows` rows, or that has nothing to
    validate on, keeps its sizes and a status that says so; its scores are NULL.
    """
    train_error = F.abs(F.col(Y) - F.col("prediction"))
    scores = score_columns(Y, "prediction", protocol.cost_under, protocol.cost_over, F.col("is_valid"))
    made = predicted.groupBy(*keys, "candidate", "family", "fold").agg(
        F.max("n_features").alias("n_features"),
        F.count_if("is_fit").alias("n_train"),
        F.count_if("is_calibration").alias("n_calibration"),
        F.avg(F.when(F.col("is_fit"), train_error)).alias("train_MAE"),
        *scores,
    ).withColumnRenamed("n", "n_validation")
    status = (
        F.when(F.col("n_train") < protocol.min_rows, "short_fit")
        .when(F.col("n_calibration") < protocol.min_rows, "short_calibration")
        .when(F.col("n_validation") == 0, "no_validation")
        .otherwise("ok")
    )
    ok = F.col("status") == "ok"
    return made.withColumn("status", status).withColumns({c: F.when(ok, F.col(c)) for c in ("train_MAE", *SCORES)})


def narrow(table: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()) -> list[str]:
    """Columns that a scored row still needs."""
    wanted = [*keys, TS, Y, "fold", *ROLES, *extra]
    return [c for c in wanted if c in table.columns]


def evaluate(
    table: DataFrame, candidates: Sequence[Candidate], protocol: Protocol, keys: Sequence[str] = ()
) -> DataFrame:
    """Scores of expression candidates on all folds of all series in one pass."""
    predicted = with_candidates(table, candidates)
    slim = predicted.select(*keys, TS, Y, "candidate", "family", "n_features", "prediction")
    return cv_rows(fold_roles(slim, protocol), protocol, keys)


def evaluate_model(
    table: DataFrame,
    name: str,
    family: str,
    n_features: int,
    fit: Callable[[DataFrame], tuple[Callable[[DataFrame], DataFrame], int]],
    protocol: Protocol,
    keys: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Back-test of a fitted model: the score rows and the predictions of all folds.

    `fit` gets the rows of one fold with their roles and returns a function that adds
    `prediction`, and the number of boosting rounds (0 where there are none). One model is fitted
    per fold, pooled over all series.
    """
    parts = []
    for f in protocol.folds:
        rows = fold_roles(table, _only(protocol, f))
        predict, rounds = fit(rows)
        parts.append(
            predict(rows)
            .select(*narrow(rows, keys), "prediction")
            .withColumns(
                {
                    "candidate": F.lit(name),
                    "family": F.lit(family),
                    "n_features": F.lit(n_features),
                    "best_iteration": F.lit(rounds),
                }
            )
        )
    predicted = parts[0]
    for part in parts[1:]:
        predicted = predicted.unionByName(part)
    rounds_per_fold = predicted.groupBy("fold").agg(F.max("best_iteration").alias("best_iteration"))
    return cv_rows(predicted, protocol, keys).join(rounds_per_fold, "fold"), predicted


def _only(protocol: Protocol, fold: Span) -> Protocol:
    return replace(protocol, folds=(fold,))


def interval_cv(predicted: DataFrame, protocol: Protocol, keys: Sequence[str] = ()) -> DataFrame:
    """Coverage and width per candidate, fold and interval method, for each series.

    The radius comes from the calibration rows of the fold, the scores from its validation rows.
    Folds with too few calibration rows stay, with NULL coverage and width.
    """
    by = [*keys, "candidate", "fold", "method"]
    rows = predicted.filter("is_calibration OR is_valid").withColumn(
        "method", F.explode(F.array(*[F.lit(m) for m in METHODS]))
    )
    rows = with_series_radius(
        rows, by, F.col("is_calibration"), F.col("method"), protocol.alpha, min_n=protocol.min_rows
    )
    return interval_scores(bounds(rows.filter("is_valid"), "q", F.col("method")), by)


def pooled_interval_cv(predicted: DataFrame, protocol: Protocol) -> DataFrame:
    """The same with one radius for all series together, whatever their number."""
    by = ["candidate", "fold"]
    radii = conformal_radii(predicted.filter("is_calibration"), protocol.alpha, by, METHODS, min_n=protocol.min_rows)
    return interval_scores(apply_radius(predicted.filter("is_valid"), radii, by), [*by, "method"])


def select(cv: DataFrame, protocol: Protocol, keys: Sequence[str] = ()) -> DataFrame:
    """Leaderboard with the champion of each series flagged.

    A candidate with a fold that is too short or missing has no scores and is not chosen, so a series
    without enough history has no champion; `n_short` says why.
    """
    return champion(leaderboard(cv, keys, len(protocol.folds)), protocol.metric, keys=keys)


def interval_choice(per_fold: DataFrame, protocol: Protocol, keys: Sequence[str] = ()) -> DataFrame:
    return choose_interval(interval_summary(per_fold, keys), protocol.alpha, keys)


def final_slices(table: DataFrame, protocol: Protocol) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fit rows before the calibration span less the embargo, calibration rows, and test rows by period."""
    fit = table.filter(F.col(TS) < ntz(protocol.calibration.start - protocol.embargo))
    calibration = table.filter(in_span(TS, protocol.calibration.start, protocol.calibration.end))
    return fit, calibration, assign_periods(table, protocol.periods)


def final_predictions(
    predicted: DataFrame, protocol: Protocol, method: str | DataFrame = "absolute", keys: Sequence[str] = ()
) -> DataFrame:
    """Test rows with bounds from the calibration rows of the same series and candidate.

    `predicted` holds the predictions of both. `method` is one method for all series or a frame
    (keys, method). Series whose calibration rows are too few have no radius: their rows keep the
    prediction and its errors, with NULL bounds and the reason `too_few_calibration_rows`.
    """
    spans = [protocol.calibration, *protocol.periods]
    marks = exploded_literals([{"period": s.name, "start": ntz(s.start), "end": ntz(s.end)} for s in spans])
    inside = (F.col(TS) >= F.col("_p.start")) & (F.col(TS) < F.col("_p.end"))
    rows = predicted.withColumn("_p", F.explode(marks)).filter(inside)
    rows = rows.withColumn("period", F.col("_p.period")).drop("_p")
    if isinstance(method, str):
        rows = rows.withColumn("method", F.lit(method))
    else:
        rows = attach(rows, method.select(*keys, "method"), keys)
    calibration = F.col("period") == protocol.calibration.name
    rows = with_series_radius(
        rows, [*keys, "candidate"], calibration, F.col("method"), protocol.alpha, min_n=protocol.min_rows
    )
    reason = F.when(F.col("q").isNull(), "too_few_calibration_rows").alias("reason")
    tests = rows.filter(~calibration).select("*", reason)
    return with_errors(bounds(tests, "q", F.col("method")))


def final_scores(pred: DataFrame, protocol: Protocol, keys: Sequence[str] = ()) -> DataFrame:
    """One row per period and candidate: rows, coverage, width and scores."""
    scores = score_columns(Y, "prediction", protocol.cost_under, protocol.cost_over)
    return pred.groupBy(*keys, "period", "candidate").agg(
        F.avg(F.col("covered").cast("double")).alias("coverage"),
        F.avg(F.col("upper") - F.col("lower")).alias("mean_width"),
        *scores,
    )


def final_evaluation(
    table: DataFrame,
    candidates: Sequence[Candidate],
    protocol: Protocol,
    method: str | DataFrame = "absolute",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Test predictions of expression candidates with bounds, errors and coverage flags."""
    return final_predictions(with_candidates(table, candidates), protocol, method, keys)
