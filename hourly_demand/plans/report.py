"""The numbers of an experiment report as one long table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import ablation, improvement

PERIOD_FIGURES = ("MAE", "RMSE", "WAPE_pct", "BusinessLoss", "BusinessLossPerHour", "coverage", "mean_width")
BOARD_FIGURES = ("MAE_mean", "MAE_std", "train_MAE_mean", "n_features")


def _melt(df: DataFrame, keys: Sequence[str], section, subject, figures: Sequence[str]) -> DataFrame:
    rows = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in figures]
    )
    return df.select(*keys, section.alias("section"), subject.alias("subject"), F.inline(rows))


def findings(
    board: DataFrame,
    results: DataFrame,
    alpha: float = 0.1,
    keys: Sequence[str] = (),
    baseline: str = "WeeklyNaive",
) -> DataFrame:
    """Rows (section, subject, metric, value): the champion, its test scores per period, its gain
    over the baseline, its coverage against nominal, and the ablation deltas."""
    chosen = board.filter("selected")
    gap = F.col("MAE_mean") - F.col("train_MAE_mean")
    champion_rows = _melt(
        chosen.withColumn("overfit_gap", gap), keys, F.lit("champion"), F.col("candidate"), [*BOARD_FIGURES, "overfit_gap"]
    )
    mine = results.join(chosen.select(*keys, "candidate"), [*keys, "candidate"], "left_semi")
    gains = improvement(results, baseline, keys).select(*keys, "period", "candidate", "improvement_pct")
    tests = mine.join(gains, [*keys, "period", "candidate"], "left").withColumn(
        "coverage_gap", F.col("coverage") - F.lit(1.0 - alpha)
    )
    period_rows = _melt(
        tests, keys, F.lit("period"), F.col("period"), [*PERIOD_FIGURES, "improvement_pct", "coverage_gap"]
    )
    reduced = ablation(board, keys)
    ablation_rows = _melt(
        reduced.withColumn("subject", F.concat_ws("_", "family", "subset")),
        keys,
        F.lit("ablation"),
        F.col("subject"),
        ["score", "full_score", "delta"],
    )
    return champion_rows.unionByName(period_rows).unionByName(ablation_rows)
