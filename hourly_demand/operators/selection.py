"""Rules that choose a candidate or an interval method.

Groups hold one row per candidate or method, so ranking them is cheap for any number of series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import METRICS


def _metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"unknown selection metric {metric}")
    return metric


def champion(board: DataFrame, metric: str = "MAE", tol: float = 0.01, keys: Sequence[str] = ()) -> DataFrame:
    """Flags the simplest candidate within `tol` of the best score.

    Ties go to fewer features, a smaller deviation over folds, a shorter latency if the board has
    one, and the name.
    """
    score, spread = f"{_metric(metric)}_mean", f"{metric}_std"
    group = Window.partitionBy(*keys)
    limit = F.min(score).over(group) * (1 + tol) + 1e-12
    marked = board.withColumn("_in", F.col(score) <= limit)
    latency = ["inference_median_s"] if "inference_median_s" in board.columns else []
    order = [F.desc_nulls_last("_in"), F.asc("n_features"), F.asc_nulls_last(spread)]
    order += [F.asc(c) for c in latency] + [F.asc("candidate")]
    rank = F.row_number().over(group.orderBy(*order))
    return marked.withColumn("selected", (rank == 1) & F.coalesce("_in", F.lit(False))).drop("_in")


def choose_interval(summary: DataFrame, alpha: float = 0.1, keys: Sequence[str] = ()) -> DataFrame:
    """Keeps the method whose coverage is nearest to nominal, then the narrowest, then by name."""
    out = summary.withColumn("coverage_gap", F.abs(F.col("coverage") - F.lit(1.0 - alpha)))
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("coverage_gap"), "mean_width", "method")
    return out.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == 1).drop("_rank")


def best_per_family(board: DataFrame, metric: str = "MAE", keys: Sequence[str] = ()) -> DataFrame:
    """Best candidate of each family; the champion stands for its own family."""
    order = [F.desc("selected"), F.asc_nulls_last(f"{_metric(metric)}_mean"), F.asc("candidate")]
    w = Window.partitionBy(*keys, "family").orderBy(*order)
    return board.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")
