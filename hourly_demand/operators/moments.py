"""Means and second moments of the columns of many rows, in one pass."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Functions sent to executors carry their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
#: Above any feature list; a column of ids named as categories would fill the memory of a task.
MAX_CATEGORIES = 4096


class Moments(NamedTuple):
    """Rows, means and products of the distances from them: of each category as 0 or 1, then of the numbers."""

    n: int
    sizes: tuple[int, ...]
    mean: np.ndarray
    scatter: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def deviations(self) -> np.ndarray:
        """Population deviations; exactly zero for equal values."""
        return np.where(self.low == self.high, 0.0, np.sqrt(np.diag(self.scatter) / self.n))

    def points(self) -> np.ndarray:
        """A few rows with the same means and the same mean products: one on either side along each principal axis."""
        varied = np.flatnonzero(self.low != self.high)
        if not len(varied):
            return self.mean[None].copy()
        scale = self.deviations()[varied]
        length, axes = np.linalg.eigh(self.scatter[np.ix_(varied, varied)] / self.n / np.outer(scale, scale))
        away = (axes * np.sqrt(np.maximum(length, 0.0) * len(varied))).T * scale
        out = np.tile(self.mean, (2 * len(varied), 1))
        out[:, varied] += np.vstack([away, -away])
        return out


def widened(some: tuple, sizes: tuple[int, ...]) -> tuple:
    """With room for more categories, of which no row was seen."""
    n, own, mean, scatter, *ends = some
    if sizes == own:
        return some
    starts, numbers = np.cumsum((0, *sizes)), len(mean) - sum(own)
    at = np.concatenate([first + np.arange(k) for first, k in zip(starts, (*own, numbers), strict=True)])
    wide = np.zeros((3, starts[-1] + numbers))
    wide[:, at] = mean, *ends
    products = np.zeros((wide.shape[1], wide.shape[1]))
    products[np.ix_(at, at)] = scatter
    return n, sizes, wide[0], products, wide[1], wide[2]


def merged(one: tuple, two: tuple) -> tuple:
    """Moments of the rows of both together."""
    sizes = tuple(map(max, one[1], two[1]))
    n, _, mean, scatter, low, high = widened(one, sizes)
    n_two, _, mean_two, scatter_two, low_two, high_two = widened(two, sizes)
    total, gap = n + n_two, mean_two - mean
    scatter = scatter + scatter_two + np.outer(gap, gap) * (n * n_two / total)
    return total, sizes, mean + gap * (n_two / total), scatter, np.minimum(low, low_two), np.maximum(high, high_two)


def of_columns(categories: list[np.ndarray], numbers: list[np.ndarray]) -> tuple:
    """Moments of some rows, given column by column."""
    parts = []
    for codes in categories:
        whole = codes.astype(np.int64)
        if (whole != codes).any() or whole.min() < 0 or whole.max() >= MAX_CATEGORIES:
            raise ValueError(f"categories must be whole numbers from 0 to {MAX_CATEGORIES - 1}")
        parts.append((whole[:, None] == np.arange(whole.max() + 1)).astype(np.float64))
    sizes = tuple(p.shape[1] for p in parts)
    x = np.hstack([*parts, np.column_stack(numbers)])
    mean, low, high = x.mean(axis=0), x.min(axis=0), x.max(axis=0)
    x -= mean
    return len(x), sizes, mean, x.T @ x, low, high


def moments(rows: DataFrame, categories: Sequence[str], numbers: Sequence[str]) -> Moments | None:
    """Of all rows, or None without rows. Runs a job that reads the rows once.

    Every task returns one matrix of the size of the column list, and these are merged on the executors first.
    A missing or infinite value is an error.
    """
    columns = [*categories, *numbers]

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            wrong = [c for c, v in zip(columns, values, strict=True) if not np.isfinite(v).all()]
            if wrong:
                raise ValueError(f"missing or infinite values in {wrong}")
            part = of_columns(values[: len(categories)], values[len(categories) :])
            total = part if total is None else merged(total, part)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], names=["moments"])

    doubles = rows.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    found = doubles.mapInArrow(of_task, "moments binary").rdd.map(lambda r: [pickle.loads(r[0])])
    total = found.treeAggregate([], _both, _both)
    return Moments(*total[0]) if total else None


def _both(one: list[tuple], two: list[tuple]) -> list[tuple]:
    """At most one each, merged."""
    return [merged(one[0], two[0])] if one and two else one or two
