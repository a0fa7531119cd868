"""Split-conformal prediction intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Y, check_alpha
from ..functions.errors import METHODS, interval_scale, lower_bound, upper_bound
from .groups import attach
from .ranks import conformal_rank, order_statistic

MIN_ROWS = 30


def conformal_radius(
    df: DataFrame,
    method: str = "absolute",
    alpha: float = 0.1,
    by: Sequence[str] = (),
    y: str = Y,
    p: str = "prediction",
    min_n: int = MIN_ROWS,
) -> DataFrame:
    """Radius q per group; NULL with a reason where the calibration rows are too few."""
    check_alpha(alpha)
    score = F.abs(F.col(y) - F.col(p)) / interval_scale(p, method)
    return order_statistic(df.withColumn("_score", score), "_score", alpha, by, min_n)


def conformal_radii(
    df: DataFrame,
    alpha: float = 0.1,
    by: Sequence[str] = (),
    methods: Sequence[str] = METHODS,
    y: str = Y,
    p: str = "prediction",
    min_n: int = MIN_ROWS,
) -> DataFrame:
    """Radii of several methods in one pass, one row per group and method."""
    check_alpha(alpha)
    out = df.withColumn("method", F.explode(F.array(*[F.lit(m) for m in methods])))
    score = F.abs(F.col(y) - F.col(p)) / interval_scale(p, F.col("method"))
    return order_statistic(out.withColumn("_score", score), "_score", alpha, [*by, "method"], min_n)


def with_series_radius(
    rows: DataFrame,
    by: Sequence[str],
    calibration: Column,
    method: Column,
    alpha: float = 0.1,
    y: str = Y,
    p: str = "prediction",
    min_n: int = MIN_ROWS,
) -> DataFrame:
    """Adds the conformal radius `q` of each group, taken from its calibration rows, in one pass.

    For groups of a single series only: they hold at most one row per hour of their spans, so a
    window is safe and neither a join nor a second computation of the rows is needed. Groups of
    many series need `conformal_radii`.
    """
    check_alpha(alpha)
    score = F.abs(F.col(y) - F.col(p)) / interval_scale(p, method)
    group = Window.partitionBy(*by)
    scored = rows.withColumn("_score", F.when(calibration, score)).withColumn("_n", F.count("_score").over(group))
    rank = F.row_number().over(group.orderBy(F.asc_nulls_last("_score")))
    marked = scored.withColumn("_hit", F.when(rank == conformal_rank(alpha, min_n)(F.col("_n")), F.col("_score")))
    return marked.withColumn("q", F.max("_hit").over(group)).drop("_score", "_n", "_hit")


def series_radii(
    df: DataFrame,
    alpha: float = 0.1,
    by: Sequence[str] = (),
    method: str = "absolute",
    y: str = Y,
    p: str = "prediction",
    min_n: int = MIN_ROWS,
) -> DataFrame:
    """Radius per single series from its calibration rows, as rows (by, method, q)."""
    marked = with_series_radius(df, by, F.lit(True), F.lit(method), alpha, y, p, min_n)
    return marked.groupBy(*by).agg(F.max("q").alias("q")).select(*by, F.lit(method).alias("method"), "q")


def bounds(df: DataFrame, q="q", method="absolute", p: str = "prediction") -> DataFrame:
    """Adds lower (not below zero) and upper from a radius column or number."""
    q = F.col(q) if isinstance(q, str) else F.lit(float(q)) if isinstance(q, (int, float)) else q
    return df.withColumns({"lower": lower_bound(p, q, method), "upper": upper_bound(p, q, method)})


def apply_radius(df: DataFrame, radii: DataFrame, by: Sequence[str] = (), how: str = "inner") -> DataFrame:
    """Joins radii (columns by, method, q) to predictions and adds the bounds.

    With `how="left"` predictions without a radius stay, with NULL bounds.
    """
    return bounds(attach(df, radii.select(*by, "method", "q"), by, how), "q", F.col("method"))
