"""Gradient boosting in blocks of rounds, with early stopping, on Spark's regression trees.

A block starts from stored rows: bins of the features, target, and the prediction so far, packed as
`trees` reads them. Each of its rounds fits one tree to the gradient of the loss and adds a step to the
prediction. At the end of a block one pass gives the losses of all its rounds on the stopping rows, and
the rows are written again with the new prediction, which cuts the lineage: however many rounds a fit takes, no plan holds more than a block of
trees, and a lost executor costs one block at most. The fit ends when `patience` rounds in a row have
not improved the loss; the rounds after the best one are dropped. So a bound of 1,500 rounds costs no
more than the rounds that are needed.

`AbsoluteLoss` repeats Spark's own boosted trees for absolute loss round by round, and its model is a
`GBTRegressionModel`. `QuantileLoss` (pinball loss) moves each leaf by the quantile of its residuals,
and its model is an `Ensemble`: all trees in one literal array that one expression walks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_folder, stored
from . import trees
from .trees import DecisionTreeRegressor

BLOCK = 10
#: Fixed value: rounds without gain after which a fit stops.
PATIENCE = 60
#: Relative rank error of leaf quantiles is 1 / ACCURACY.
ACCURACY = 10_000
#: Larger than any threshold, so that a node without a split always goes left.
NO_SPLIT = 1.7976931348623157e308


class AbsoluteLoss:
    """Mean absolute error with mean leaves: the first tree is fitted to the target itself."""

    name = "absolute"

    def start(self, train: DataFrame) -> float:
        return 0.0

    def gradient(self, number: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        return (lambda y, current: y) if number == 0 else (lambda y, current: np.where(y - current < 0, -1.0, 1.0))

    def weight(self, number: int, rate: float) -> float:
        return 1.0 if number == 0 else rate

    def loss(self, prediction: Column) -> Column:
        return F.abs(F.col("_y") - prediction)

    def leaves(self, placed: DataFrame) -> dict[int, float] | None:
        """None: the leaves keep the mean gradient."""
        return None


@dataclass(frozen=True)
class QuantileLoss:
    """Pinball loss of one quantile."""

    tau: float

    def __post_init__(self):
        if not 0 < self.tau < 1:
            raise ValueError("tau must lie between 0 and 1")

    def start(self, train: DataFrame) -> float:
        return float(train.agg(F.percentile_approx("_y", self.tau, ACCURACY).alias("q")).first()["q"] or 0.0)

    def gradient(self, number: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        tau = self.tau
        return lambda y, current: np.where(y > current, tau, tau - 1.0)

    def weight(self, number: int, rate: float) -> float:
        return rate

    def loss(self, prediction: Column) -> Column:
        gap = F.col("_y") - prediction
        return F.greatest(self.tau * gap, (self.tau - 1.0) * gap)

    def leaves(self, placed: DataFrame) -> dict[int, float]:
        """Quantile of the residuals of each leaf, by a mergeable sketch: a leaf may hold any number of rows."""
        residual = F.percentile_approx(F.col("_y") - F.col("_cur"), self.tau, ACCURACY)
        return {int(r["_leaf"]): float(r["v"]) for r in placed.groupBy("_leaf").agg(residual.alias("v")).collect()}


@dataclass(frozen=True)
class Tree:
    """A regression tree as a complete binary tree: node i has the children 2 i + 1 and 2 i + 2."""

    depth: int
    feature: list[int]
    threshold: list[float]
    value: list[float]

    def arrays(self, shape: trees.Shape) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """As `trees.walked` takes them on such features."""
        threshold = self.threshold
        if shape.limits is not None:
            threshold = [t if t == NO_SPLIT else np.searchsorted(shape.limits[j], t) for j, t in zip(self.feature, threshold, strict=True)]
        return self.depth, np.array(self.feature, np.intp), np.array(threshold, float), np.array(self.value, float)

    def padded(self, depth: int) -> Tree:
        """The same tree with more levels."""
        feature, threshold, value = list(self.feature), list(self.threshold), list(self.value)
        for d in range(self.depth, depth):
            feature += [0] * 2**d
            threshold += [NO_SPLIT] * 2**d
            value = [v for v in value for _ in (0, 1)]
        return Tree(depth, feature, threshold, value)


_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")


def read_tree(model: DecisionTreeRegressionModel, leaves: dict[int, float] | None = None) -> Tree:
    """The splits of a fitted tree, from its description. `leaves` replaces the values by number of the leaf."""
    lines = [line.strip() for line in model.toDebugString.splitlines()[1:] if line.strip()]
    depth = model.depth
    inner = 2**depth - 1
    feature, threshold, value = [0] * inner, [NO_SPLIT] * inner, [0.0] * 2**depth
    at, leaf = 0, 0

    def node(place: int, level: int) -> None:
        nonlocal at, leaf
        line = lines[at]
        at += 1
        if split := _SPLIT.match(line):
            feature[place], threshold[place] = int(split[1]), float(split[2])
            node(2 * place + 1, level + 1)
            at += 1  # the line of the other branch
            node(2 * place + 2, level + 1)
            return
        own = float(line.split(":")[1]) if leaves is None else leaves.get(leaf, 0.0)
        leaf += 1
        # All places below a leaf have its value.
        first = (place + 1 << depth - level) - 1 - inner
        value[first : first + (1 << depth - level)] = [own] * (1 << depth - level)

    node(0, 0)
    return Tree(depth, feature, threshold, value)


@dataclass(frozen=True)
class Ensemble:
    """A sum of trees over named columns."""

    columns: tuple[str, ...]
    start: float
    trees: tuple[Tree, ...]

    def expression(self) -> str:
        """SQL of the prediction. The trees are one folded literal; the plan does not grow with them.

        A NULL feature goes right.
        """
        if not self.trees:
            return f"{self.start!r}D"
        depth = max(t.depth for t in self.trees)
        wide = [t.padded(depth) for t in self.trees]
        literal = json.dumps([{"f": t.feature, "t": t.threshold, "v": t.value} for t in wide], separators=(",", ":"))
        kind = "array<struct<f:array<int>,t:array<double>,v:array<double>>>"
        row = ", ".join(f"CAST({c} AS DOUBLE)" for c in self.columns)
        step = "IF(get(x, get(n.f, i)) <= get(n.t, i), 2 * i + 1, 2 * i + 2)"
        if depth:
            levels = f"array({', '.join(map(str, range(depth)))})"
            leaf = f"aggregate({levels}, 0, (i, d) -> {step}, i -> get(n.v, i - {2**depth - 1}))"
        else:
            leaf = "get(n.v, 0)"
        # The row is bound once, as an array of one element.
        total = f"aggregate(from_json('{literal}', '{kind}'), {self.start!r}D, (s, n) -> s + {leaf})"
        return f"transform(array(array({row})), x -> {total})[0]"

    def stage(self, name: str) -> SQLTransformer:
        return SQLTransformer(statement=f"SELECT *, {self.expression()} AS {name} FROM __THIS__")


@dataclass
class Boosted:
    """What a fit leaves: fitted trees up to the best round, their weights, and the losses of all rounds tried."""

    start: float
    trees: list[DecisionTreeRegressionModel] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    leaves: list[dict[int, float] | None] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)
    best: int = 0

    def ensemble(self, columns: Sequence[str]) -> Ensemble:
        made = []
        for tree, weight, leaves in zip(self.trees, self.weights, self.leaves, strict=True):
            plain = read_tree(tree, leaves)
            made.append(Tree(plain.depth, plain.feature, plain.threshold, [weight * v for v in plain.value]))
        return Ensemble(tuple(columns), self.start, tuple(made))

    def gbt_model(self, spark: SparkSession, columns: Sequence[str]) -> GBTRegressionModel:
        """Spark's own model class of these trees and weights."""
        ml = spark.sparkContext._jvm.org.apache.spark.ml
        array = spark.sparkContext._gateway.new_array
        trees = array(ml.regression.DecisionTreeRegressionModel, len(self.trees))
        weights = array(spark.sparkContext._jvm.double, len(self.trees))
        for i, (tree, weight) in enumerate(zip(self.trees, self.weights, strict=True)):
            trees[i], weights[i] = tree._java_obj, weight
        uid = ml.util.Identifiable.randomUID("boosted")
        return GBTRegressionModel(ml.regression.GBTRegressionModel(uid, trees, weights, len(columns)))


def stopped(losses: Sequence[float], patience: int) -> int | None:
    """The best round (from 1) once `patience` rounds in a row did not improve on it, else None."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1
    return None


@contextmanager
def _few_blocks(spark: SparkSession) -> Iterator[None]:
    """Few blocks of rows pass between Spark and Python at once: each is large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(trees.BLOCKS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _stored_blocks(blocks: DataFrame) -> DataFrame:
    """As `stored`, in small row groups."""
    path = shared_folder(blocks.sparkSession, "boosting")
    blocks.write.option("parquet.block.size", 16 << 20).parquet(path)
    return blocks.sparkSession.read.schema(blocks.schema).parquet(path)


def boost(
    train: DataFrame,
    columns: Sequence[str],
    y: str,
    loss: AbsoluteLoss | QuantileLoss,
    rounds: int,
    rate: float,
    params: dict | None = None,
    seed: int = 42,
    early: DataFrame | None = None,
    patience: int = PATIENCE,
    block: int = BLOCK,
) -> Boosted:
    """Boosts at most `rounds` trees; with `early` rows, up to the best round before the fit stops.

    params: maxDepth, minInstancesPerNode and subsamplingRate as Spark's trees take them. Every round
    draws its own share of the rows by seeded hashes of their numbers. Rows with a NULL target or
    feature are an error of the feature assembler, as in Spark's own fit.
    """
    params = dict(params or {})
    share = params.pop("subsamplingRate", 1.0)
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    label = F.col(y).cast("double").alias("_y")
    parts = [assembler.transform(train).select("features", label, F.lit(True).alias("_fit"))]
    if early is not None:
        parts.append(assembler.transform(early).select("features", label, F.lit(False).alias("_fit")))
    rows = parts[0] if early is None else parts[0].unionByName(parts[1])
    # Written with their numbers, so that a lost task makes the same rows again.
    rows = stored(rows.withColumn("features", vector_to_array("features")).withColumn("_id", F.monotonically_increasing_id()), "boosting")
    fitted, spark = rows.filter("_fit"), rows.sparkSession
    out = Boosted(loss.start(fitted))
    bins = DecisionTreeRegressor(**params).getMaxBins()
    many, most = fitted.count(), trees.sample_rows(bins)
    # Thresholds are found on the rows of a round or, as in Spark's own boosting, once on a sample of all where they are many.
    limits = None
    if share == 1 or many * share > most:
        mark = F.pmod(F.xxhash64(F.lit(seed), F.lit(-1), "_id"), F.lit(1 << 30)) / (1 << 30)
        some = fitted.filter(mark < most / many) if many > most else fitted
        limits = trees.thresholds(trees.matrix(some.select("features").toArrow().column(0).combine_chunks(), len(columns)).T, bins)
    shape = trees.Shape(len(columns), limits)
    current = _stored_blocks(rows.mapInArrow(trees.packed(shape, out.start), trees.BLOCKS))
    with _few_blocks(spark):
        _rounds(out, current, shape, loss, rounds, rate, share, params, seed, early is not None, patience, block, bins)
    best = len(out.trees)
    if early is not None:
        best = stopped(out.losses, patience) or 1 + min(range(len(out.losses)), key=out.losses.__getitem__)
    out.best = best
    out.trees, out.weights, out.leaves = out.trees[:best], out.weights[:best], out.leaves[:best]
    return out


def _rounds(out: Boosted, current: DataFrame, shape: trees.Shape, loss, rounds: int, rate: float, share: float, params: dict, seed: int, early: bool, patience: int, block: int, bins: int) -> None:
    """Fits the trees of `out` to the stored blocks `current`, block by block."""
    while len(out.trees) < rounds:
        walks: list[tuple] = []
        first, last = len(out.trees), min(len(out.trees) + block, rounds)
        for number in range(first, last):
            draw, limits = ((seed, number), share) if share < 1 else None, shape.limits
            if limits is None:
                drawn = current.mapInArrow(trees.drawn_rows(shape, draw), "features binary").collect()
                limits = trees.thresholds(np.hstack([shape.of(r["features"]) for r in drawn]).T, bins)
            # A fit reads its rows once per level; the trees of the block are walked once.
            drawn = current.mapInArrow(trees.advanced(shape, walks, loss.gradient(number), limits, draw), "features binary, _g binary").persist()
            try:
                fitter = DecisionTreeRegressor(featuresCol="features", labelCol="_g", predictionCol="_step", leafCol="_leaf", seed=seed + number, **params)
                fitter.limits = limits
                tree = fitter.fit(drawn)
            finally:
                drawn.unpersist()
            numbers = read_tree(tree, {k: float(k) for k in range(tree.numNodes)}).arrays(shape)
            leaves = loss.leaves(current.mapInArrow(trees.targets(shape, walks, numbers, (), True), "_y double, _cur double, _leaf int"))
            weight = loss.weight(number, rate)
            depth, feature, threshold, value = read_tree(tree, leaves).arrays(shape)
            walks.append((depth, feature, threshold, weight * value))
            out.trees.append(tree)
            out.weights.append(weight)
            out.leaves.append(leaves)
        if early:
            tried = [f"_round_{number}" for number in range(first, last)]
            schema = ", ".join(["_y double, _cur double, _leaf int", *[f"{c} double" for c in tried]])
            found = current.mapInArrow(trees.targets(shape, walks, None, tried, False), schema).agg(*[F.avg(loss.loss(F.col(c))).alias(c) for c in tried]).first()
            out.losses += [float("inf") if found[c] is None else found[c] for c in tried]
            if stopped(out.losses, patience) is not None:
                break
        if len(out.trees) < rounds:
            current = _stored_blocks(current.mapInArrow(trees.moved(shape, walks), trees.BLOCKS))
