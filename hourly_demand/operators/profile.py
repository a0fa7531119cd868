"""Exploratory statistics of panels, per series or for one series."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TS, Y
from ..functions.time import floor_day
from ..sources.shared import stored
from .groups import attach, sized
from .ranks import quantiles
from .windows import lags

PERCENTILES = {"p01": 0.01, "p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}


def target_stats(
    df: DataFrame,
    by: Sequence[str] = (),
    value: str = Y,
    approximate: bool = False,
    single_series: bool = False,
) -> DataFrame:
    """Count, mean, sample deviation, extremes and percentiles of the known values.

    `approximate` replaces the exact percentiles by a mergeable sketch. `single_series` states that
    each group is one series, so that the exact ones fit into the same pass.
    """
    v = F.col(value).cast("double")
    basics = [
        F.count(v).alias("count"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    ]
    if approximate or single_series:
        shares = list(PERCENTILES.values())
        cuts = F.percentile_approx(v, shares, 10000) if approximate else F.percentile(v, F.array(*map(F.lit, shares)))
        out = df.groupBy(*by).agg(*basics, cuts.alias("_p"))
        return out.select(*[c for c in out.columns if c != "_p"], *_unpack("_p"))
    exact = quantiles(df, value, PERCENTILES, by).drop("n")
    return attach(df.groupBy(*by).agg(*basics), exact, by, "left")


def _unpack(name: str) -> list[Column]:
    return [F.col(name)[i].alias(p) for i, p in enumerate(PERCENTILES)]


def zero_missing(df: DataFrame, by: Sequence[str] = (), value: str = Y) -> DataFrame:
    """Rows, missing values, and the share of zeros among the known values."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_if(F.col(value).isNull()).alias("n_missing"),
        F.avg((F.col(value) == 0).cast("double")).alias("zero_share"),
    )


def profile(df: DataFrame, dim: str, by: Sequence[str] = (), value: str = Y) -> DataFrame:
    """Mean value along one dimension."""
    return df.groupBy(*by, dim).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def profiles(df: DataFrame, by: Sequence[str] = (), value: str = Y, ts: str = TS) -> DataFrame:
    """Hour-of-day and weekday profiles; 24 x 7 cells are aggregated once and rolled up twice."""
    cells = df.groupBy(*by, F.hour(ts).alias("hour"), F.weekday(ts).alias("weekday")).agg(
        F.sum(F.col(value).cast("double")).alias("_s"), F.count(value).alias("_n")
    )
    cols = [F.col(c) for c in [*by, "hour", "weekday"]]
    sets = [[F.col(c) for c in [*by, d]] for d in ("hour", "weekday")]
    out = cells.groupingSets(sets, *cols).agg(
        F.sum("_s").alias("_s"), F.sum("_n").alias("n"), F.grouping("hour").alias("_g")
    )
    by_hour = F.col("_g") == 0
    return out.select(
        *by,
        F.when(by_hour, "hour").otherwise("weekday").alias("dimension"),
        F.when(by_hour, F.col("hour")).otherwise(F.col("weekday")).alias("value"),
        F.when(F.col("n") > 0, F.col("_s") / F.col("n")).alias("mean"),
        "n",
    )


def peak_trough(df: DataFrame, by: Sequence[str] = (), value: str = Y, ts: str = TS) -> DataFrame:
    """Hours of day with the highest and lowest mean; the earlier hour wins a tie."""
    means = df.groupBy(*by, F.hour(ts).alias("hour")).agg(F.avg(value).alias("mean"))
    return means.groupBy(*by).agg(
        F.max_by("hour", F.struct("mean", -F.col("hour"))).alias("peak_hour"),
        F.max("mean").alias("peak_mean"),
        F.min_by("hour", F.struct("mean", "hour")).alias("trough_hour"),
        F.min("mean").alias("trough_mean"),
    )


def daily_resample(df: DataFrame, keys: Sequence[str] = (), value: str = Y, ts: str = TS) -> DataFrame:
    """Sum per day; NULL when no hour of the day is known."""
    return df.groupBy(*keys, floor_day(ts).alias("day")).agg(F.sum(F.col(value).cast("double")).alias("total"))


def distinct_days(df: DataFrame, by: Sequence[str] = (), ts: str = TS) -> DataFrame:
    return df.select(*by, floor_day(ts).alias("day")).distinct()


def histogram(df: DataFrame, value: str = Y, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Counts in equal-width bins between minimum and maximum; the last bin is closed on the right.

    Empty bins are listed. A constant sample uses the unit interval around its value. With groups,
    the limits are computed at once.
    """
    v = F.col(value).cast("double")
    known = df.filter(v.isNotNull()).select(*by, v.alias("_v"))
    limits = known.groupBy(*by).agg(F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    flat = F.col("_a") == F.col("_b")
    limits = limits.select(
        *by,
        F.when(flat, F.col("_a") - 0.5).otherwise(F.col("_a")).alias("_a"),
        F.when(flat, F.col("_b") + 0.5).otherwise(F.col("_b")).alias("_b"),
    )
    if by:
        limits = sized(limits)
    width = (F.col("_b") - F.col("_a")) / bins
    number = F.least(F.lit(bins - 1), F.floor((F.col("_v") - F.col("_a")) / width)).cast("int")
    counted = attach(known, limits, by).groupBy(*by, number.alias("bin")).agg(F.count("*").alias("n"))
    every = limits.filter(F.col("_a").isNotNull()).withColumn(
        "bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))
    )
    return every.join(counted, [*by, "bin"], "left").select(
        *by,
        "bin",
        (F.col("_a") + F.col("bin") * width).alias("lo"),
        (F.col("_a") + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def autocorr(panel: DataFrame, offsets: Sequence[int] = (1, 24, 168), keys: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of the series with itself k hours earlier, over pairs that are both known."""
    shifted = lags(panel, offsets, keys)
    y = F.col(Y).cast("double")
    wide = shifted.groupBy(*keys).agg(*[_corr(y, F.col(f"lag_{k}").cast("double")).alias(f"_{k}") for k in offsets])
    pairs = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_{k}").alias("r")) for k in offsets])
    return wide.select(*keys, F.inline(pairs))


def _corr(a: Column, b: Column) -> Column:
    """Correlation over complete pairs, or NULL where one side does not vary.

    The built-in `corr` fails on a constant side in ANSI mode, whatever surrounds it.
    """
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns as rows (a, b, r); NULL for a constant column.

    Rows must be complete. Spark ML adds up one covariance matrix per task, so only matrices of the
    size of the column list leave the tasks. Spark ML reads the rows twice and the first one before, so they are stored
    and made once. Runs jobs.
    """
    vectors = stored(VectorAssembler(inputCols=list(cols), outputCol="_v").transform(df).select("_v"), "vectors")
    matrix = Correlation.corr(vectors, "_v").first()[0].toArray()
    rows = [
        (a, b, None if math.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(cols)
        for j, b in enumerate(cols)
    ]
    return df.sparkSession.createDataFrame(rows, "a STRING, b STRING, r DOUBLE")
