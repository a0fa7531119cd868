"""What a model relies on: gains, permutations, shifted groups and coefficients.

Permutations work on all rows, or on a time-strided sample per series if its size is given.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TS, Y
from ..operators.groups import attach, exploded_literals, null_safe_join
from ..operators.permutation import partner, round_keys, shape
from ..operators.windows import positions, stride_sample
from ..sources.shared import checkpoint_root

Predictor = Callable[[DataFrame], DataFrame]
SAMPLE = None
# Column prefixes of the feature groups.
GROUPS = {"lags": ("lag_",), "rolling": ("roll_",), "calendar": ("hour", "weekday", "is_")}


def feature_groups(columns: Sequence[str]) -> dict[str, list[str]]:
    found = {g: [c for c in columns if c.startswith(prefixes)] for g, prefixes in GROUPS.items()}
    return {g: cols for g, cols in found.items() if cols}


def gain_importance(model: PipelineModel, columns: Sequence[str], spark: SparkSession) -> DataFrame:
    """Gain of each feature of a boosted-tree model, normalised to a sum of 1."""
    trees = next(s for s in model.stages if isinstance(s, GBTRegressionModel))
    gains = trees.featureImportances.toArray()
    rows = [(c, float(g)) for c, g in zip(columns, gains, strict=True)]
    return spark.createDataFrame(rows, "feature STRING, gain DOUBLE")


def coefficients(model: PipelineModel, sample: DataFrame) -> DataFrame:
    """Coefficients of a ridge model with the names of the encoded features."""
    linear = next(s for s in model.stages if isinstance(s, LinearRegressionModel))
    meta = model.transform(sample.limit(1)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for kind in meta.values() for a in kind}
    rows = [(names.get(i, str(i)), float(c)) for i, c in enumerate(linear.coefficients.toArray())]
    return sample.sparkSession.createDataFrame(rows, "feature STRING, coefficient DOUBLE")


def _numbered(table: DataFrame, keys: Sequence[str], target_n: int | None, columns: Sequence[str]) -> DataFrame:
    """The rows, or a sample of them, with positions; they are used several times, so they are stored once."""
    checkpoint_root(table.sparkSession)
    rows = table.select(*keys, TS, Y, *columns)
    sample = rows if target_n is None else stride_sample(rows, target_n, keys)
    return positions(sample, keys, total="_n").drop(TS).checkpoint()


def _with_partner(copies: DataFrame, rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """copies, whose rows name the position `_take` of a row of their series, with that row's columns as `_from`."""
    given = rows.select(*keys, F.col("pos").alias("_take"), F.struct(*columns).alias("_from"))
    return null_safe_join(copies, given, [*keys, "_take"]).drop("_take")


def _replaced(joined: DataFrame, sets: dict[str, Sequence[str]], columns: Sequence[str], label: str) -> DataFrame:
    """One row per set of columns, in which these columns come from the partner. Nothing is shuffled for it."""
    variants = [
        F.struct(F.lit(name).alias(label), *[(F.col(f"_from.{c}") if c in moved else F.col(c)).alias(c) for c in columns])
        for name, moved in sets.items()
    ]
    return joined.withColumn("_variant", F.explode(F.array(*variants))).drop(*columns, "_from").select("*", "_variant.*").drop("_variant")


def _mae(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.abs(F.col(Y) - F.col("prediction"))).alias(name))


def _summarise(shuffled: DataFrame, base: DataFrame, label: str, predict: Predictor) -> DataFrame:
    """Mean and population deviation over repeats of the MAE above the base."""
    per_repeat = attach(_mae(predict(shuffled), [label, "repeat"], "mae"), base, ())
    return per_repeat.groupBy(label).agg(
        F.avg(F.col("mae") - F.col("base")).alias("mae_increase"),
        F.stddev_pop(F.col("mae") - F.col("base")).alias("std"),
    )


def permutation_importance(
    table: DataFrame,
    predict: Predictor,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    repeats: int = 5,
    seed: int = 42,
    target_n: int | None = SAMPLE,
) -> DataFrame:
    """Rise of the MAE when one feature is shuffled within its series, for every feature and repeat.

    A keyed bijection gives the row that takes part in a shuffle by arithmetic, so nothing is sorted.
    A repeat uses one shuffle for all features: each row meets its partner once, and the features are
    replaced one by one beside it. So a row is shuffled once per repeat, whatever the number of features.
    """
    base_rows = _numbered(table, keys, target_n, columns)
    base = _mae(predict(base_rows), [], "base")
    jobs = exploded_literals([{"repeat": r, "_keys": F.lit(round_keys(seed, r)).cast("array<bigint>")} for r in range(repeats)])
    copies = base_rows.withColumn("_shape", shape(F.col("_n"))).select("*", F.inline(jobs))
    copies = copies.withColumn("_take", partner(F.col("pos"), F.col("_n"), F.col("_shape"), F.col("_keys"))).drop("_keys", "_shape")
    joined = _with_partner(copies, base_rows, keys, columns)
    return _summarise(_replaced(joined, {c: [c] for c in columns}, columns, "feature"), base, "feature", predict)


def draw_shifts(repeats: int, groups: Sequence[str], seed: int) -> list[dict]:
    """A uniform draw in [0, 1) for each group and repeat; it becomes a shift once the size is known."""
    rng = random.Random(seed)
    return [{"group": g, "repeat": r, "draw": rng.random()} for g in groups for r in range(repeats)]


def shift_rows(n, draw):
    """Shift in [24, max(25, n - 24)) for a draw in [0, 1)."""
    return (F.lit(24) + F.floor(draw * (F.greatest(F.lit(25), n - 24) - 24))).cast("bigint")


def group_importance(
    table: DataFrame,
    predict: Predictor,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    repeats: int = 5,
    seed: int = 42,
    target_n: int | None = SAMPLE,
    shifts: Sequence[int] | None = None,
) -> DataFrame:
    """Rise of the MAE when a whole group of features is shifted cyclically in time.

    The columns of a group move together, so their correlation stays. `shifts` fixes the shifts
    instead of drawing them.
    """
    groups = feature_groups(columns)
    base_rows = _numbered(table, keys, target_n, columns)
    base = _mae(predict(base_rows), [], "base")
    if shifts is None:
        jobs = draw_shifts(repeats, list(groups), seed)
        copies = base_rows.select("*", F.inline(exploded_literals(jobs)))
        copies = copies.withColumn("_shift", shift_rows(F.col("_n"), F.col("draw"))).drop("draw")
    else:
        jobs = [{"group": g, "repeat": r, "_shift": int(s)} for g in groups for r, s in enumerate(shifts)]
        copies = base_rows.select("*", F.inline(exploded_literals(jobs)))
    copies = copies.withColumn("_take", F.pmod(F.col("pos") - F.col("_shift"), F.col("_n"))).drop("_shift")
    joined = _with_partner(copies, base_rows, keys, columns)
    member = {c: g for g, cols in groups.items() for c in cols}
    swapped = {
        c: F.when(F.col("group") == g, F.col(f"_from.{c}")).otherwise(F.col(c)) for c, g in member.items()
    }
    return _summarise(joined.withColumns(swapped).drop("_from"), base, "group", predict)


def top_features(importance: DataFrame, score: str, n: int = 12) -> DataFrame:
    return importance.orderBy(F.desc(score), "feature").limit(n)

