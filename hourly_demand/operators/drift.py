"""Drift monitoring against a reference distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Y
from ..functions.errors import is_finite
from .groups import attach, sized
from .ranks import quantiles

# Multiples of a step of 0.1, so 0.30000000000000004 and not 0.3: where a decile falls exactly on a
# value, this decides on which side of the edge the value lies.
DECILES = {f"d{i:02d}": i * 0.1 for i in range(11)}
PSI_LIMIT = 0.2
COVERAGE_LIMIT = 0.85
# Added to every bin count, so that empty bins keep a probability.
BIN_PRIOR = 0.5


MAX_BINS = len(DECILES) - 1


def _bin_counts(v: Column, edges: Column) -> Column:
    """Aggregate: rows per bin as an array of MAX_BINS counts.

    Bins are closed on the left. There are at most ten, so they are ten conditional counts of the
    same pass as any other aggregate, and an empty bin simply counts zero.
    """
    counts = []
    for i in range(MAX_BINS):
        lo, hi = F.get(edges, F.lit(i)), F.get(edges, F.lit(i + 1))
        last = F.lit(i + 2) == F.size(edges)
        inside = (v >= lo) & (last | (v < hi))
        counts.append(F.count_if(inside))
    return F.array(*counts)


def _shares(counts: Column, edges: Column) -> Column:
    """Smoothed share of each bin."""
    many = F.raise_error(F.lit(f"a reference may have at most {MAX_BINS} bins")).cast("int")
    bins = F.when(F.size(edges) > MAX_BINS + 1, many).otherwise(F.size(edges) - 1)
    smoothed = F.transform(F.slice(counts, F.lit(1), bins), lambda c: c + BIN_PRIOR)
    total = F.aggregate(smoothed, F.lit(0.0), lambda s, c: s + c)
    return F.transform(smoothed, lambda c: c / total)


def _psi(observed: Column, expected: Column) -> Column:
    terms = F.zip_with(observed, expected, lambda o, e: (o - e) * F.log(o / e))
    return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)


def reference_edges(
    df: DataFrame, by: Sequence[str] = (), value: str = Y, single_series: bool = False
) -> DataFrame:
    """Distinct inner deciles between infinite ends; a constant sample gives one bin."""
    cut = quantiles(df, value, DECILES, by, single_series=single_series)
    cuts = F.array_distinct(F.array(*[F.col(c) for c in DECILES]))
    inner = F.when(F.size(cuts) > 2, F.slice(cuts, 2, F.size(cuts) - 2)).otherwise(F.array().cast("array<double>"))
    edges = F.concat(F.array(F.lit(float("-inf"))), inner, F.array(F.lit(float("inf"))))
    return cut.select(*by, edges.alias("edges"))


def reference_distribution(
    df: DataFrame, by: Sequence[str] = (), value: str = Y, single_series: bool = False
) -> DataFrame:
    """Decile edges and smoothed bin shares of a reference sample, one row per group.

    `single_series` states that each group is one series; its deciles then take one pass.
    """
    edges = reference_edges(df, by, value, single_series)
    if by and not single_series:
        edges = sized(edges)
    known = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    counted = (
        attach(known, edges, by)
        .groupBy(*by)
        .agg(F.any_value("edges").alias("edges"), _bin_counts(F.col("_v"), F.col("edges")).alias("_counts"))
    )
    return counted.select(*by, "edges", _shares(F.col("_counts"), F.col("edges")).alias("probabilities"))


def bin_table(reference: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Reference distribution as rows (bin, lo, hi, probability); open ends are NULL."""
    out = reference.select(*by, "edges", F.posexplode("probabilities").alias("bin", "probability"))
    lo, hi = F.get("edges", F.col("bin")), F.get("edges", F.col("bin") + 1)
    return out.select(
        *by,
        "bin",
        F.when(is_finite(lo), lo).alias("lo"),
        F.when(is_finite(hi), hi).alias("hi"),
        "probability",
    )


def psi(
    df: DataFrame,
    reference: DataFrame,
    by: Sequence[str] = (),
    ref_by: Sequence[str] = (),
    value: str = Y,
) -> DataFrame:
    """Population stability index of each group of `by` against its reference.

    `ref_by` are the columns of `by` that the reference is kept for (none: one reference for all).
    """
    known = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    counted = (
        attach(known, _reference(reference, ref_by), ref_by)
        .groupBy(*by)
        .agg(*_drift_aggregates(F.col("_v")), F.count("*").alias("n"))
    )
    return counted.select(*by, _psi_of_group().alias("psi"), "n")


def _reference(reference: DataFrame, ref_by: Sequence[str]) -> DataFrame:
    """The reference, stored and sized when there are several."""
    reference = reference.select(*ref_by, "edges", "probabilities")
    return sized(reference) if ref_by else reference


def _drift_aggregates(v: Column) -> list[Column]:
    return [
        _bin_counts(v, F.col("edges")).alias("_counts"),
        F.any_value("edges").alias("_edges"),
        F.any_value("probabilities").alias("_expected"),
    ]


def _psi_of_group() -> Column:
    return _psi(_shares(F.col("_counts"), F.col("_edges")), F.col("_expected"))


def alert_list(psi_: Column, mae: Column | None, coverage: Column | None, max_mae: float | None) -> Column:
    """Codes of the exceeded limits."""
    found = [F.when(psi_ > PSI_LIMIT, "psi_above_0.2")]
    if mae is not None and max_mae is not None:
        found.append(F.when(mae > max_mae, "mae_above_limit"))
    if coverage is not None:
        found.append(F.when(coverage < COVERAGE_LIMIT, "coverage_below_0.85"))
    return F.array_compact(F.array(*found))


#: Sums that make a monitoring row; all of them add up over parts of a group.
SUMS = ("n", "n_bad", "sum_abs", "sum_square", "sum_target", "n_bounded", "n_covered")


def _sum_columns(y: str) -> list[Column]:
    good = is_finite(y) & is_finite("prediction")
    e = F.when(good, F.col(y) - F.col("prediction"))
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(~good).alias("n_bad"),
        F.sum(F.abs(e)).alias("sum_abs"),
        F.sum(e * e).alias("sum_square"),
        F.sum(F.when(good, F.col(y).cast("double"))).alias("sum_target"),
        F.count("covered").alias("n_bounded"),
        F.count_if("covered").alias("n_covered"),
        _bin_counts(F.col(y).cast("double"), F.col("edges")).alias("bins"),
    ]


def _monitoring_rows(sums: DataFrame, by: Sequence[str], max_mae: float | None) -> DataFrame:
    """Rows from sums with the edges and probabilities of their reference."""
    ok = F.col("n_bad") == 0
    share = F.lit(100) * F.col("sum_abs") / F.col("sum_target")
    out = sums.withColumns(
        {
            "psi": _psi(_shares(F.col("bins"), F.col("edges")), F.col("probabilities")),
            "MAE": F.when(ok, F.col("sum_abs") / F.col("n")),
            "RMSE": F.when(ok, F.sqrt(F.col("sum_square") / F.col("n"))),
            "WAPE_pct": F.when(ok & (F.col("sum_target") != 0), share),
            "coverage": F.when(F.col("n_bounded") > 0, F.col("n_covered") / F.col("n_bounded")),
        }
    )
    alerts = alert_list(F.col("psi"), F.col("MAE"), F.col("coverage"), max_mae).alias("alerts")
    return out.select(*by, "psi", "n", "n_bad", "MAE", "RMSE", "WAPE_pct", "coverage", alerts)


def _with_coverage(pred: DataFrame, y: str) -> DataFrame:
    return pred if "covered" in pred.columns else pred.withColumn("covered", F.col(y).between(F.col("lower"), F.col("upper")))


def monitor_sums(
    pred: DataFrame, reference: DataFrame, by: Sequence[str] = ("period",), ref_by: Sequence[str] = (), y: str = Y
) -> DataFrame:
    """What some predictions add to the monitoring of their groups: counts by bin, sums of errors."""
    joined = attach(_with_coverage(pred, y), reference.select(*ref_by, "edges"), ref_by)
    return joined.groupBy(*by).agg(*_sum_columns(y))


def monitor_merged(
    sums: DataFrame,
    reference: DataFrame,
    by: Sequence[str] = ("period",),
    ref_by: Sequence[str] = (),
    max_mae: float | None = None,
) -> DataFrame:
    """Monitoring row per group from any number of its parts."""
    bins = F.array(*[F.sum(F.get("bins", F.lit(i))) for i in range(MAX_BINS)]).alias("bins")
    whole = sums.groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS], bins)
    return _monitoring_rows(attach(whole, reference.select(*ref_by, "edges", "probabilities"), ref_by), by, max_mae)


def monitor(
    pred: DataFrame,
    reference: DataFrame,
    by: Sequence[str] = ("period",),
    ref_by: Sequence[str] = (),
    max_mae: float | None = None,
    y: str = Y,
) -> DataFrame:
    """Monitoring row per group in one pass: PSI, scores, coverage and alerts.

    Predictions need `prediction`, and `covered` or the bounds. Rows with a missing or infinite
    target are counted in `n_bad` and leave the scores of their group NULL.
    """
    joined = attach(_with_coverage(pred, y), _reference(reference, ref_by), ref_by)
    expected = [F.any_value(c).alias(c) for c in ("edges", "probabilities")]
    return _monitoring_rows(joined.groupBy(*by).agg(*_sum_columns(y), *expected), by, max_mae)
