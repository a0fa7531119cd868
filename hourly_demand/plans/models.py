"""Spark ML models pooled over all series: ridge, boosted trees and quantile boosting."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, SQLTransformer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Y, Protocol
from ..operators.moments import moments
from .backtest import evaluate_model
from .boosting import BLOCK, PATIENCE, AbsoluteLoss, Boosted, QuantileLoss, boost

#: Columns that are one-hot encoded for the linear model; all others are standardised.
ONE_HOT = {"hour", "weekday"}
LEARNING_RATE = 0.05
# Search ranges. Log-uniform for the penalty, uniform for the trees.
RIDGE_ALPHA = (0.1, 1000.0)
TREE_SPACE = {"maxDepth": (3, 6), "minInstancesPerNode": (30, 200), "subsamplingRate": (0.5, 1.0)}
MAX_LEAVES = 1024

Predictor = Callable[[DataFrame], DataFrame]


def clip_stage(source: str = "raw_prediction") -> SQLTransformer:
    """Last stage of every model: predictions below zero become zero."""
    return SQLTransformer(statement=f"SELECT *, greatest(0D, {source}) AS prediction FROM __THIS__")


def standard_stage(numeric: Sequence[str], means: Sequence[float], deviations: Sequence[float]) -> SQLTransformer:
    """Standardises with the means and population deviations of the training rows."""
    parts = [
        f"(CAST({c} AS DOUBLE) - ({float(mean)!r}D)) / ({float(std)!r}D) AS z_{c}"
        for c, mean, std in zip(numeric, means, deviations, strict=True)
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def one_hot_stage(spark: SparkSession, columns: Sequence[str], sizes: Sequence[int]) -> OneHotEncoderModel:
    """Encodes categories from 0 on; categories not seen in training are all zero."""
    encoder = OneHotEncoder(inputCols=list(columns), outputCols=[f"onehot_{c}" for c in columns], handleInvalid="keep", dropLast=True)
    highest = ", ".join(f"{size - 1} AS {c}" for c, size in zip(columns, sizes, strict=True))
    return encoder.fit(spark.sql(f"SELECT {highest}"))


def fit_ridge(train: DataFrame, columns: Sequence[str], alpha: float, y: str = Y) -> PipelineModel:
    """Least squares with an L2 penalty of `alpha` on the squared coefficients, intercept free.

    Hour and weekday are one-hot encoded, other columns standardised. Rows are read once and not kept: scaling,
    categories and the normal equations all follow from one matrix of moments. Spark fits a few points that have
    the same moments. It divides the loss by the rows and scales the label by its deviation, so the penalty is
    rescaled to keep the usual objective.
    """
    spark = train.sparkSession
    one_hot, numeric = [c for c in columns if c in ONE_HOT], [c for c in columns if c not in ONE_HOT]
    found = moments(train, one_hot, [*numeric, y])
    if found is None:
        raise ValueError("no rows to fit")
    first, deviations = sum(found.sizes), found.deviations()
    stages = []
    if numeric:
        # A deviation of zero counts as 1.
        deviations[first:-1] = np.where(deviations[first:-1] == 0, 1.0, deviations[first:-1])
        stages.append(standard_stage(numeric, found.mean[first:-1], deviations[first:-1]))
    if one_hot:
        stages.append(one_hot_stage(spark, one_hot, found.sizes))
    inputs = [*[f"onehot_{c}" for c in one_hot], *[f"z_{c}" for c in numeric]]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    points = found.points()
    points[:, first:-1] = (points[:, first:-1] - found.mean[first:-1]) / deviations[first:-1]
    solver = LinearRegression(
        featuresCol="features",
        labelCol=y,
        predictionCol="raw_prediction",
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
        regParam=alpha * (float(deviations[-1]) or 1.0) / found.n,
    )
    alike = spark.createDataFrame([(Vectors.dense(p[:-1]), float(p[-1])) for p in points], ["features", y])
    return PipelineModel(stages=[*stages, solver.fit(alike.coalesce(1)), clip_stage()])


def fit_gbt(
    train: DataFrame,
    columns: Sequence[str],
    params: dict | None = None,
    early: DataFrame | None = None,
    core: DataFrame | None = None,
    rounds: int = 100,
    seed: int = 42,
    y: str = Y,
    patience: int = PATIENCE,
    block: int = BLOCK,
) -> tuple[PipelineModel, int]:
    """Boosted trees with absolute loss, as Spark's own boosting fits them.

    With `core` and `early`, a first fit on `core` stops once `patience` rounds have not lowered the
    loss on `early`; the model is then fitted on `train` with the best number of rounds.
    """
    made, best = _boosted(AbsoluteLoss(), train, columns, params, early, core, rounds, LEARNING_RATE, seed, y, patience, block)
    trees = made.gbt_model(train.sparkSession, columns).setFeaturesCol("features").setPredictionCol("raw_prediction")
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    return PipelineModel(stages=[assembler, trees, clip_stage()]), best


def fit_quantile(
    train: DataFrame,
    columns: Sequence[str],
    tau: float,
    stages: int = 100,
    learning_rate: float = LEARNING_RATE,
    params: dict | None = None,
    early: DataFrame | None = None,
    core: DataFrame | None = None,
    seed: int = 42,
    y: str = Y,
    patience: int = PATIENCE,
    block: int = BLOCK,
) -> tuple[PipelineModel, int]:
    """Gradient boosting for the quantile `tau` (pinball loss), and its number of rounds.

    `core` and `early` stop it as they stop `fit_gbt`. The model is one literal of all trees and one
    expression that walks it, so its plan has the same size for any number of rounds. `tau` = 0.5 is
    L1 boosting with median leaves.
    """
    if 2 ** (params or {}).get("maxDepth", 5) > MAX_LEAVES:
        raise ValueError("maxDepth is too large")
    made, best = _boosted(QuantileLoss(tau), train, columns, params, early, core, stages, learning_rate, seed, y, patience, block)
    return PipelineModel(stages=[made.ensemble(columns).stage("raw_prediction"), clip_stage()]), best


def _boosted(loss, train, columns, params, early, core, rounds, rate, seed, y, patience, block) -> tuple[Boosted, int]:
    """A fit on `core` finds the rounds if there are stopping rows; the fit on `train` takes as many."""
    best = rounds
    if early is not None and core is not None:
        best = boost(core, columns, y, loss, rounds, rate, params, seed, early, patience, block).best
    return boost(train, columns, y, loss, best, rate, params, seed, block=block), best


@dataclass(frozen=True)
class ModelSpec:
    """A family, its parameters and its columns."""

    name: str
    family: str
    columns: tuple[str, ...]
    params: dict = field(default_factory=dict)

    def fit(
        self, rows: DataFrame, protocol: Protocol, rounds: int = 100, stages: int | None = None
    ) -> tuple[PipelineModel | None, int]:
        """Fits on rows that carry fold roles, or on all rows when they have none."""
        has_roles = "is_fit" in rows.columns
        train = rows.filter("is_fit") if has_roles else rows
        if self.family == "WeeklyNaive":
            return None, 0
        if self.family == "Ridge":
            return fit_ridge(train, self.columns, self.params["alpha"]), 0
        if self.family != "Trees":
            raise ValueError(f"unknown family {self.family}")
        core, early = (rows.filter("is_core"), rows.filter("is_early")) if has_roles else (None, None)
        if protocol.metric == "BusinessLossPerHour":
            n = stages or rounds
            return fit_quantile(train, self.columns, protocol.tau, n, params=self.params, early=early, core=core, seed=protocol.seed)
        return fit_gbt(train, self.columns, self.params, early, core, rounds, protocol.seed)

    def predictor(self, model: PipelineModel | None) -> Predictor:
        if model is None:
            return lambda df: df.withColumn("prediction", F.col("lag_168").cast("double"))
        return model.transform


def back_test(
    table: DataFrame, spec: ModelSpec, protocol: Protocol, keys: Sequence[str] = (), rounds: int = 100
) -> tuple[DataFrame, DataFrame]:
    def fit(rows: DataFrame) -> tuple[Predictor, int]:
        model, best = spec.fit(rows, protocol, rounds)
        return spec.predictor(model), best

    return evaluate_model(table, spec.name, spec.family, len(spec.columns), fit, protocol, keys)


def draw_params(family: str, rng: random.Random) -> dict:
    """One random point of the search space of a family."""
    if family == "Ridge":
        lo, hi = (math.log(v) for v in RIDGE_ALPHA)
        return {"alpha": math.exp(rng.uniform(lo, hi))}
    depth, rows, share = TREE_SPACE["maxDepth"], TREE_SPACE["minInstancesPerNode"], TREE_SPACE["subsamplingRate"]
    return {
        "maxDepth": rng.randint(*depth),
        "minInstancesPerNode": rng.randint(*rows),
        "subsamplingRate": rng.uniform(*share),
    }


@dataclass(frozen=True)
class Trial:
    number: int
    params: dict
    score: float
    spread: float


def search(
    table: DataFrame,
    family: str,
    columns: Sequence[str],
    protocol: Protocol,
    rounds: int = 100,
    parallelism: int = 2,
) -> list[Trial]:
    """Seeded random search on the calendar folds; the trial history in order of number.

    Trials are independent Spark ML fits, a few at a time. Each returns one score.
    """
    rng = random.Random(protocol.seed)
    draws = [draw_params(family, rng) for _ in range(protocol.trials)]

    def run(job: tuple[int, dict]) -> Trial:
        number, params = job
        spec = ModelSpec(f"{family}_trial{number}", family, tuple(columns), params)
        cv, _ = back_test(table, spec, protocol, rounds=rounds)
        row = cv.agg(F.avg(protocol.metric).alias("m"), F.stddev_samp(protocol.metric).alias("s")).first()
        return Trial(number, params, row["m"], row["s"])

    with ThreadPool(min(parallelism, len(draws))) as pool:
        return pool.map(run, list(enumerate(draws)))


def best_trial(trials: Sequence[Trial]) -> Trial:
    return min(trials, key=lambda t: (t.score, t.number))


def ablation_specs(family: str, params: dict, sets: dict[str, list[str]]) -> list[ModelSpec]:
    """The best parameters with each feature set."""
    return [ModelSpec(f"{family}_{name}", family, tuple(cols), params) for name, cols in sets.items()]


def trials_frame(spark, trials: Sequence[Trial], family: str) -> DataFrame:
    """Trial history as a table."""
    rows = [(family, t.number, {k: float(v) for k, v in t.params.items()}, t.score, t.spread) for t in trials]
    return spark.createDataFrame(
        rows, "family STRING, trial INT, params MAP<STRING, DOUBLE>, score DOUBLE, score_std DOUBLE"
    )
