"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import checkpoint_root

BROADCAST_ROWS = 100_000


def attach(df: DataFrame, summary: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Joins a per-group summary back to the rows.

    With groups, the join strategy is left to Catalyst and AQE, which broadcast the summary
    only when its measured size is small; a NULL in `by` is a group like any other. Without groups
    the summary is a single row, read as one scalar subquery of all its columns, so there is no
    join; more than one row is an error.
    """
    if by:
        return null_safe_join(df, summary, by, how)
    row = summary.select(F.struct(*summary.columns).alias("_row")).scalar()
    return df.withColumn("_row", row).withColumns({c: F.col("_row")[c] for c in summary.columns}).drop("_row")


def unbroadcast(rows: DataFrame) -> DataFrame:
    """Marks a side that has a row per hour, or per document, so that a join sorts it and never sends it through the driver.

    Spark's estimate does not see rows multiply in `explode`, and Parquet files of mostly equal hours are tiny,
    so it would broadcast millions of rows.
    """
    return rows.hint("merge")


def null_safe_join(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal or both NULL columns, which appear once."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in by})
    same = F.lit(True)
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in by])


def null_safe_anti(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of left without a row in right that is equal in `by`; NULL equals NULL."""
    renamed = right.select(*[F.col(k).alias(f"_right_{k}") for k in by])
    same = F.lit(True)
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(renamed, same, "left_anti")


def sized(summary: DataFrame) -> DataFrame:
    """Stores a per-group summary and marks it for broadcast if it proves small. Runs jobs.

    The size of an aggregate is not known before it has run, so Spark would plan a join that
    shuffles the rows, all rows of a hot group to one task. With the summary stored, its rows are
    counted: a small one is broadcast and the rows stay where they are; a large one has so many
    groups that the join is left to Catalyst, with AQE splitting skewed partitions.
    """
    checkpoint_root(summary.sparkSession)
    stored = summary.checkpoint()
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def exploded_literals(rows: list[dict]) -> Column:
    """A literal array of structs for a handful of configured rows (folds, periods, scenarios)."""
    return F.array(*[F.struct(*[_lit(v).alias(k) for k, v in row.items()]) for row in rows])


def _lit(value):
    return value if isinstance(value, Column) else F.lit(value)
