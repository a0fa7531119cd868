"""Boosting in blocks against Spark's one-piece fit and a plain pinball fit."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from hourly_demand.plans import boosting, models, trees
from hourly_demand.plans.boosting import AbsoluteLoss, Ensemble, QuantileLoss, Tree, boost, stopped

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    df = pd.DataFrame({"a": rng.integers(0, 24, 400), "b": rng.integers(0, 15, 400), "c": rng.integers(0, 2, 400)})
    df["y"] = 20 + 10 * np.sin(df.a / 4) + 2.0 * df.b * df.c + rng.gamma(2.0, 3.0, 400)
    df["part"] = np.arange(400) % 4 == 0
    return df


@pytest.fixture(scope="module")
def rows(spark, frame):
    df = spark.createDataFrame(frame).persist()
    df.count()
    return df


def split(rows):
    return rows.filter("NOT part"), rows.filter("part")


def test_blocks_equal_one_piece_fit(spark, rows):
    core, early = split(rows)
    assembler = VectorAssembler(inputCols=COLUMNS, outputCol="features")
    whole = GBTRegressor(featuresCol="features", labelCol="y", lossType="absolute", stepSize=0.3, maxIter=7, maxDepth=3, seed=5).fit(assembler.transform(core))
    want = whole.evaluateEachIteration(assembler.transform(early), "absolute")
    made = {b: boost(core, COLUMNS, "y", AbsoluteLoss(), 7, 0.3, {"maxDepth": 3}, 5, early, patience=100, block=b) for b in (2, 7)}
    for found in made.values():
        np.testing.assert_allclose(found.losses, want, rtol=1e-12)
        assert found.best == 1 + int(np.argmin(want)) == len(found.trees)
    ours = made[2].gbt_model(spark, COLUMNS)
    best = GBTRegressor(featuresCol="features", labelCol="y", lossType="absolute", stepSize=0.3, maxIter=ours.getNumTrees, maxDepth=3, seed=5).fit(assembler.transform(core))
    a, b = (m.transform(assembler.transform(early)).orderBy("a", "b", "c", "y").toPandas().prediction for m in (ours, best))
    np.testing.assert_allclose(a, b)
    np.testing.assert_allclose(ours.featureImportances.toArray(), best.featureImportances.toArray())


def test_bounded_at_1500_rounds_it_stops_by_itself(rows):
    # Steps of a mean sign are at most 0.05, so a target in small units needs fewer of them.
    rows = rows.withColumn("y", F.col("y") / 60)
    core, early = split(rows)
    model, best = models.fit_gbt(rows, COLUMNS, {"maxDepth": 2}, early, core, rounds=1500, y="y", patience=6, block=4)
    assert model.stages[1].getNumTrees == best < 200
    found = boost(core, COLUMNS, "y", AbsoluteLoss(), 1500, models.LEARNING_RATE, {"maxDepth": 2}, 42, early, 6, 4)
    assert found.best == best and best + 6 <= len(found.losses) <= best + 6 + 4
    assert min(found.losses) == found.losses[best - 1]


def test_stop_rule():
    assert stopped([], 1) is None and stopped([3, 2, 1], 1) is None
    assert stopped([3, 1, 1, 2, 0], 2) == 2
    assert stopped([3, 1, 2, 0.5, 9, 9], 2) == 4
    assert stopped([math.inf, math.inf], 1) == 1


def plain_tree(x, g, depth, least):
    """Greedy least-squares tree; leaves as index arrays from left to right."""

    def grow(idx, level):
        best = None
        if level < depth and len(idx) >= 2 * least:
            parent = g[idx].var() * len(idx)
            for f in range(x.shape[1]):
                values = np.unique(x[idx, f])
                for t in (values[1:] + values[:-1]) / 2:
                    left = x[idx, f] <= t
                    if min(left.sum(), (~left).sum()) < least:
                        continue
                    gain = parent - g[idx][left].var() * left.sum() - g[idx][~left].var() * (~left).sum()
                    if best is None or gain > best[0] + 1e-9:
                        best = gain, f, t
        if best is None or best[0] <= 1e-12:
            return [(idx, ())]
        _, f, t = best
        left = x[idx, f] <= t
        return grow(idx[left], level + 1) + grow(idx[~left], level + 1)

    return [leaf[0] for leaf in grow(np.arange(len(x)), 0)]


@pytest.mark.parametrize("tau, least", [(0.75, 1), (0.5, 20)])
def test_quantile_boosting_equals_a_direct_pinball_fit(rows, frame, tau, least):
    x, y = frame[COLUMNS].to_numpy(float), frame.y.to_numpy()
    low = lambda v: np.sort(v)[math.ceil(tau * len(v)) - 1]
    current = np.full(len(y), low(y))
    for _ in range(6):
        g = np.where(y > current, tau, tau - 1)
        step = np.zeros(len(y))
        for leaf in plain_tree(x, g, 2, least):
            step[leaf] = low((y - current)[leaf])
        current = current + 0.3 * step
    model, n = models.fit_quantile(rows, COLUMNS, tau, 6, 0.3, {"maxDepth": 2, "minInstancesPerNode": least}, y="y", block=4)
    assert n == 6
    got = model.transform(rows).select(*COLUMNS, "y", "raw_prediction").toPandas()
    key = lambda df, v: sorted(zip(df.a, df.b, df.c, df.y, v, strict=True))
    np.testing.assert_allclose(key(got, got.raw_prediction), key(frame, current))


def test_many_rounds_have_a_bounded_plan(spark, rows):
    few, _ = models.fit_quantile(rows, COLUMNS, 0.75, 2, 0.2, {"maxDepth": 2}, y="y")
    many, _ = models.fit_quantile(rows, COLUMNS, 0.75, 24, 0.2, {"maxDepth": 2}, y="y", block=12)
    assert len(many.stages) == len(few.stages) == 2
    plans = [m.transform(rows)._jdf.queryExecution().optimizedPlan() for m in (few, many)]
    assert plans[0].treeString().count("\n") == plans[1].treeString().count("\n")
    loss = lambda m: m.transform(rows).agg(F.avg(F.greatest(0.75 * (F.col("y") - F.col("prediction")), -0.25 * (F.col("y") - F.col("prediction"))))).first()[0]
    assert loss(many) < 0.6 * loss(few)


def test_quantile_boosting_stops_early_and_takes_a_share(rows):
    core, early = split(rows)
    params = {"maxDepth": 3, "subsamplingRate": 0.6, "minInstancesPerNode": 10}
    model, best = models.fit_quantile(rows, COLUMNS, 0.75, 1500, 0.3, params, early, core, y="y", patience=5, block=5)
    again, same = models.fit_quantile(rows, COLUMNS, 0.75, 1500, 0.3, params, early, core, y="y", patience=5, block=3)
    assert 1 <= best == same < 200
    share = model.transform(rows).agg(F.avg((F.col("y") <= F.col("prediction")).cast("double"))).first()[0]
    assert 0.6 < share < 0.9


def test_walk_of_literal_trees(spark):
    deep = Tree(2, [0, 1, 0], [1.0, 5.0, boosting.NO_SPLIT], [1.0, 2.0, 3.0, 3.0])
    flat = Tree(0, [], [], [10.0])
    sql = Ensemble(("p", "q"), 0.5, (deep, flat)).expression()
    df = spark.createDataFrame([(1.0, 5.0), (1.0, 5.1), (1.1, 0.0), (float("inf"), 0.0), (-1e300, -1.0), (None, 0.0)], "p double, q double")
    assert [r[0] for r in df.selectExpr(sql).collect()] == [11.5, 12.5, 13.5, 13.5, 11.5, 13.5]
    assert [r[0] for r in df.selectExpr(Ensemble(("p",), 2.0, ()).expression()).limit(1).collect()] == [2.0]
    assert [r[0] for r in df.selectExpr(Ensemble(("p",), 2.0, (flat,)).expression()).limit(1).collect()] == [12.0]


def test_models_are_stored(rows, tmp_path):
    gbt, _ = models.fit_gbt(rows, COLUMNS, {"maxDepth": 2}, rounds=3, y="y")
    quantile, _ = models.fit_quantile(rows, COLUMNS, 0.75, 3, params={"maxDepth": 2}, y="y")
    for name, model in (("g", gbt), ("q", quantile)):
        model.write().overwrite().save(str(tmp_path / name))
        total = lambda m: m.transform(rows).agg(F.sum("prediction")).first()[0]
        assert total(PipelineModel.load(str(tmp_path / name))) == pytest.approx(total(model))


def test_one_constant_target(spark):
    df = spark.createDataFrame([(float(i % 3), 7.0) for i in range(60)], "a double, y double")
    model, _ = models.fit_quantile(df, ["a"], 0.75, 3, y="y")
    assert model.transform(df).select("prediction").distinct().collect()[0][0] == 7.0
    with pytest.raises(ValueError):
        QuantileLoss(1.0)
    with pytest.raises(ValueError):
        models.fit_quantile(df, ["a"], 0.5, 1, params={"maxDepth": 11}, y="y")


def test_rows_of_a_round_are_made_once(spark, rows, monkeypatch):
    held = []

    class Watched(boosting.DecisionTreeRegressor):
        def fit(self, dataset, params=None):
            held.append(dataset.storageLevel.useMemory and dataset.columns == ["features", "_g"])
            return super().fit(dataset, params)

    monkeypatch.setattr(boosting, "DecisionTreeRegressor", Watched)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for loss in (AbsoluteLoss(), QuantileLoss(0.75)):
        boost(rows, COLUMNS, "y", loss, 3, 0.3, {"maxDepth": 2, "subsamplingRate": 0.7})
    assert held == [True] * 6
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


@pytest.mark.parametrize("params", [{"maxDepth": 0}, {"maxDepth": 4}, {"maxDepth": 4, "minInstancesPerNode": 60, "maxBins": 8}, {"maxDepth": 3, "minInfoGain": 0.4}])
@pytest.mark.parametrize("held", [trees.SUMS_BYTES, 1000])
def test_trees_of_blocks_are_sparks_trees(spark, monkeypatch, params, held):
    # Small sums: some nodes at a time, added up per node by the tasks.
    monkeypatch.setattr(trees, "SUMS_BYTES", held)
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.normal(size=900), rng.integers(0, 5, 900), np.full(900, 2.0), rng.integers(0, 40, 900)]).astype(float)
    g = np.round(x[:, 0]) * (x[:, 1] > 2) + (x[:, 3] > 30) + rng.integers(0, 3, 900)
    rows = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, g, strict=True)], "a double, b double, c double, d double, _g double")
    want = DecisionTreeRegressor(labelCol="_g", seed=1, **params).fit(VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(rows))
    fitter = trees.DecisionTreeRegressor(labelCol="_g", seed=1, **params)
    fitter.limits = trees.thresholds(x, fitter.getMaxBins())
    blocks = [(trees.binned(x[i : i + 70].T, fitter.limits).tobytes(), g[i : i + 70].tobytes()) for i in range(0, 900, 70)]
    made = fitter.fit(spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in blocks], "features binary, _g binary"))
    assert made.toDebugString.splitlines()[1:] == want.toDebugString.splitlines()[1:]
    np.testing.assert_allclose(made.featureImportances.toArray(), want.featureImportances.toArray())


def test_marks_are_sparks_hashes(spark):
    ids = np.array([0, 1, 77, 1 << 40, -5])
    made = spark.createDataFrame([(int(i),) for i in ids], "id bigint").select((F.pmod(F.xxhash64(F.lit(42), F.lit(-3), "id"), F.lit(1 << 30)) / (1 << 30)).alias("m"))
    np.testing.assert_array_equal(trees.marks((42, -3), ids), [r["m"] for r in made.collect()])


def test_a_round_holds_blocks_of_bins(spark, monkeypatch):
    held = []

    class Watched(boosting.DecisionTreeRegressor):
        def fit(self, dataset, params=None):
            row = dataset.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("features")).alias("bytes")).first()
            held.append((row["n"], row["bytes"]))
            return super().fit(dataset, params)

    monkeypatch.setattr(boosting, "DecisionTreeRegressor", Watched)
    # More rows than thresholds are found on.
    many = spark.range(0, 30000, 1, 4).select(*[(F.rand(i) * (i + 1)).alias(c) for i, c in enumerate(COLUMNS)]).withColumn("y", F.col("a") + F.when(F.col("c") > 2, 5.0).otherwise(0.0))
    found = boost(many.persist(), COLUMNS, "y", AbsoluteLoss(), 3, 0.3, {"maxDepth": 3})
    assert all(n < 100 and size == 30000 * len(COLUMNS) for n, size in held) and len(held) == 3
    root = boosting.read_tree(found.trees[0])
    assert root.feature[0] == 2 and abs(root.threshold[0] - 2) < 0.1
    many.unpersist()
