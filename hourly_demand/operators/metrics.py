"""Forecast scores, losses, leaderboards and error segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TS, Y, check_costs
from ..functions.errors import is_finite, loss
from .groups import exploded_literals

SCORES = ("MAE", "RMSE", "WAPE_pct", "BusinessLoss", "BusinessLossPerHour")


def score_columns(
    y: str = Y, p: str = "prediction", under: float = 3.0, over: float = 1.0, where: Column | None = None
) -> list[Column]:
    """Aggregates n, n_bad and all scores of a group, in one pass.

    `where` restricts the aggregates to some rows. Scores are NULL when a value is missing or
    not finite; WAPE is NULL when the targets add up to zero.
    """
    check_costs(under, over)
    keep = F.lit(True) if where is None else where
    good = is_finite(y) & is_finite(p)
    e = F.when(keep & good, F.col(y) - F.col(p))
    cost = F.when(keep & good, loss(y, p, under, over))
    n_bad = F.count_if(keep & ~good)
    ok = n_bad == 0
    total = F.sum(F.when(keep & good, F.col(y)))
    return [
        F.count_if(keep).alias("n"),
        n_bad.alias("n_bad"),
        F.when(ok, F.avg(F.abs(e))).alias("MAE"),
        F.when(ok, F.sqrt(F.avg(e * e))).alias("RMSE"),
        F.when(ok & (total != 0), 100 * F.sum(F.abs(e)) / total).alias("WAPE_pct"),
        F.when(ok, F.sum(cost)).alias("BusinessLoss"),
        F.when(ok, F.avg(cost)).alias("BusinessLossPerHour"),
    ]


def metrics(df: DataFrame, by: Sequence[str] = (), y: str = Y, p: str = "prediction") -> DataFrame:
    """MAE, RMSE and WAPE per group."""
    return df.groupBy(*by).agg(*score_columns(y, p)[:5])


def business_loss(
    df: DataFrame,
    under: float = 3.0,
    over: float = 1.0,
    by: Sequence[str] = (),
    y: str = Y,
    p: str = "prediction",
) -> DataFrame:
    """Sum and mean of the asymmetric loss per group."""
    columns = score_columns(y, p, under, over)
    return df.groupBy(*by).agg(*columns[:2], *columns[5:])


def cost_scenarios(
    pred: DataFrame,
    scenarios: Sequence[tuple[str, float, float]],
    by: Sequence[str] = (),
    y: str = Y,
    p: str = "prediction",
) -> DataFrame:
    """Loss of stored predictions under other penalties.

    The loss is linear in the penalties, so under- and over-estimated trips are summed once and
    priced afterwards; rows are not multiplied by scenarios.
    """
    for _, under, over in scenarios:
        check_costs(under, over)
    e = F.col(y) - F.col(p)
    sums = pred.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sum(F.greatest(F.lit(0.0), e)).alias("_under"),
        F.sum(F.greatest(F.lit(0.0), -e)).alias("_over"),
    )
    rows = [{"scenario": s, "under": float(u), "over": float(o)} for s, u, o in scenarios]
    total = F.col("_s.under") * F.col("_under") + F.col("_s.over") * F.col("_over")
    return sums.withColumn("_s", F.explode(exploded_literals(rows))).select(
        *by,
        "n",
        F.col("_s.scenario").alias("scenario"),
        F.col("_s.under").alias("cost_under"),
        F.col("_s.over").alias("cost_over"),
        total.alias("BusinessLoss"),
        (total / F.col("n")).alias("BusinessLossPerHour"),
    )


def leaderboard(cv: DataFrame, keys: Sequence[str] = (), folds: int | None = None) -> DataFrame:
    """One row per candidate over its folds; deviations are sample deviations.

    A group holds one row per fold, so the exact median is cheap. If the rows carry a status, or the
    number of folds is given, `n_short` counts the folds that are not usable or missing; a candidate
    that has one has no scores, as a mean over other folds would not compare with the others'.
    """
    scores = [
        F.avg("MAE").alias("MAE_mean"),
        F.stddev_samp("MAE").alias("MAE_std"),
        F.percentile("MAE", F.lit(0.5)).alias("MAE_median"),
        F.max("MAE").alias("MAE_max"),
        F.avg("RMSE").alias("RMSE_mean"),
        F.avg("WAPE_pct").alias("WAPE_mean"),
        F.avg("BusinessLossPerHour").alias("BusinessLossPerHour_mean"),
        F.stddev_samp("BusinessLossPerHour").alias("BusinessLossPerHour_std"),
        F.avg("train_MAE").alias("train_MAE_mean"),
    ]
    sizes = [F.max("n_features").alias("n_features"), F.countDistinct("fold").alias("n_folds")]
    if "status" not in cv.columns:
        return cv.groupBy(*keys, "candidate", "family").agg(*scores, *sizes)
    board = cv.groupBy(*keys, "candidate", "family").agg(*scores, *sizes, F.count_if(F.col("status") != "ok").alias("n_short"))
    if folds is not None:
        board = board.withColumn("n_short", F.col("n_short") + F.lit(folds) - F.col("n_folds"))
    scored = [c for c in board.columns if c.rsplit("_", 1)[-1] in ("mean", "std", "median", "max")]
    return board.withColumns({c: F.when(F.col("n_short") == 0, F.col(c)) for c in scored})


def interval_scores(df: DataFrame, by: Sequence[str] = (), y: str = Y) -> DataFrame:
    """Coverage (both ends inclusive), mean width and rows per group."""
    return df.groupBy(*by).agg(
        F.avg(F.col(y).between(F.col("lower"), F.col("upper")).cast("double")).alias("coverage"),
        F.avg(F.col("upper") - F.col("lower")).alias("mean_width"),
        F.count("*").alias("n"),
    )


def interval_summary(per_fold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean over folds of coverage and width, per method."""
    return per_fold.groupBy(*keys, "method").agg(
        F.avg("coverage").alias("coverage"), F.avg("mean_width").alias("mean_width")
    )


def error_segments(
    pred: DataFrame, dims: Sequence[str] = ("hour", "weekday", "is_holiday"), by: Sequence[str] = ("period",)
) -> DataFrame:
    """MAE, coverage and rows per period and value of each dimension, all dimensions in one pass."""
    cols = [*by, *dims]
    sets = [[F.col(c) for c in [*by, d]] for d in dims]
    out = pred.groupingSets(sets, *[F.col(c) for c in cols]).agg(
        F.avg("abs_error").alias("MAE"),
        F.avg(F.col("covered").cast("double")).alias("coverage"),
        F.count("*").alias("n"),
        *[F.grouping(d).alias(f"_g_{d}") for d in dims],
    )
    name = F.coalesce(*[F.when(F.col(f"_g_{d}") == 0, F.lit(d)) for d in dims])
    value = F.coalesce(*[F.when(F.col(f"_g_{d}") == 0, F.col(d)) for d in dims])
    return out.select(*by, name.alias("dimension"), value.alias("value"), "MAE", "coverage", "n")


def with_errors(pred: DataFrame, y: str = Y) -> DataFrame:
    """Adds abs_error and covered to predictions with bounds."""
    return pred.withColumns(
        {
            "abs_error": F.abs(F.col(y) - F.col("prediction")),
            "covered": F.col(y).between(F.col("lower"), F.col("upper")),
        }
    )


def improvement(results: DataFrame, baseline: str = "WeeklyNaive", keys: Sequence[str] = ()) -> DataFrame:
    """Percent reduction of MAE against the baseline of the same period; NULL for a perfect baseline."""
    on = [*keys, "period"]
    base = results.filter(F.col("candidate") == baseline).select(*on, F.col("MAE").alias("baseline_MAE"))
    gain = F.when(F.col("baseline_MAE") != 0, 100 * (1 - F.col("MAE") / F.col("baseline_MAE")))
    return results.join(base, on).select(*on, "candidate", "MAE", "baseline_MAE", gain.alias("improvement_pct"))


def ablation(board: DataFrame, keys: Sequence[str] = (), metric: str = "MAE_mean") -> DataFrame:
    """Reduced feature set minus full set of the same family; positive favours the full set."""
    subset = F.regexp_extract("candidate", r"_([a-z]+)$", 1)
    on = [*keys, "family"]
    rows = board.select(*on, "candidate", subset.alias("subset"), metric)
    full = rows.filter(F.col("subset") == "full").select(*on, F.col(metric).alias("full_score"))
    reduced = rows.filter(F.col("subset").isin("calendar", "lags"))
    return reduced.join(full, on).select(
        *on, "subset", F.col(metric).alias("score"), "full_score", (F.col(metric) - F.col("full_score")).alias("delta")
    )


def overfit_gap(cv: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Validation MAE minus train MAE per candidate."""
    return cv.groupBy(*keys, "candidate").agg(
        F.avg("train_MAE").alias("train_MAE"),
        F.avg("MAE").alias("validation_MAE"),
        (F.avg("MAE") - F.avg("train_MAE")).alias("gap"),
    )


def check_cv(cv: DataFrame, n_folds: int, keys: Sequence[str] = ()) -> DataFrame:
    """Candidates with their number of folds and whether it is complete without doubles."""
    out = cv.groupBy(*keys, "candidate").agg(
        F.countDistinct("fold").alias("n_folds"), F.count("*").alias("n_rows")
    )
    return out.withColumn("ok", (F.col("n_folds") == n_folds) & (F.col("n_rows") == n_folds))


def median_rounds(cv: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Number of trees for the final fit: the median best iteration, rounded down, at least 1."""
    rounds = F.greatest(F.lit(1), F.floor(F.percentile("best_iteration", F.lit(0.5))))
    return cv.groupBy(*keys, "candidate").agg(rounds.cast("int").alias("rounds"))


def profile_errors(pred: DataFrame, dim: str, by: Sequence[str] = ("period",)) -> DataFrame:
    """Mean absolute error along one dimension."""
    return pred.groupBy(*by, dim).agg(F.avg("abs_error").alias("MAE"))


def worst_hours(pred: DataFrame, n: int = 15, keys: Sequence[str] = ()) -> DataFrame:
    """The n largest absolute errors; ties are ordered by series and time."""
    order = [F.desc("abs_error"), *keys, TS]
    return pred.orderBy(*order).limit(n).select(*keys, TS, Y, "prediction", "abs_error")
