"""Row-level error, loss and interval expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METHODS = ("absolute", "scaled")


def is_finite(c: str | Column) -> Column:
    """False for NULL, NaN and both infinities."""
    c = (F.col(c) if isinstance(c, str) else c).cast("double")
    inf = F.lit(float("inf"))
    return F.coalesce((c > -inf) & (c < inf), F.lit(False))


def loss(y: str | Column, p: str | Column, under: float, over: float) -> Column:
    """Asymmetric cost of one hour; under-estimates cost `under` per trip."""
    y = F.col(y) if isinstance(y, str) else y
    p = F.col(p) if isinstance(p, str) else p
    return under * F.greatest(F.lit(0.0), y - p) + over * F.greatest(F.lit(0.0), p - y)


def interval_scale(p: str | Column, method: str | Column) -> Column:
    """1, or the square root of the prediction but at least 1 for `scaled`."""
    p = F.col(p) if isinstance(p, str) else p
    root = F.sqrt(F.greatest(F.lit(1.0), p))
    if isinstance(method, Column):
        return F.when(method == "scaled", root).otherwise(F.lit(1.0))
    if method not in METHODS:
        raise ValueError(f"unknown interval method {method}")
    return root if method == "scaled" else F.lit(1.0)


def lower_bound(p: str | Column, q: str | Column, method: str | Column) -> Column:
    p_ = F.col(p) if isinstance(p, str) else p
    q_ = F.col(q) if isinstance(q, str) else q
    low = p_ - q_ * interval_scale(p, method)
    # greatest() would turn an unknown bound into 0.
    return F.when(low.isNotNull(), F.greatest(F.lit(0.0), low))


def upper_bound(p: str | Column, q: str | Column, method: str | Column) -> Column:
    p_ = F.col(p) if isinstance(p, str) else p
    q_ = F.col(q) if isinstance(q, str) else q
    return p_ + q_ * interval_scale(p, method)


def non_negative(p: str | Column) -> Column:
    """Clips predictions at zero."""
    return F.greatest(F.lit(0.0), F.col(p) if isinstance(p, str) else p)
