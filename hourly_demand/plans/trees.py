"""Spark's regression trees, grown from sums over the bins of the features.

Spark's own fit finds the thresholds, puts each feature into its bins and counts the rows again for every tree, on
vectors of doubles. Here rows are held in blocks, one binary per column, so that they pass between Spark and numpy as
they are; numpy adds up the rows, sums and squares of all bins per task, once per level. The choice of splits, the
pruning and the nodes are Spark's, and the model is Spark's own class. The driver gets sums of bins only, which the
tasks of a large cluster add up per node first.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import regression
from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import DataFrame, SparkSession

# Functions sent to executors carry their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
#: Rows that the thresholds are found on, as Spark takes them; at least the square of the bins.
SAMPLE_ROWS = 10_000
#: Bytes of sums that a task holds, and that the driver gets from all tasks at once.
SUMS_BYTES = 32 << 20
#: As Spark's: a smaller impurity is none.
EPSILON = 2.0**-52


def sample_rows(bins: int) -> int:
    """Rows beyond which thresholds are found on a sample."""
    return max(bins * bins, SAMPLE_ROWS)


def thresholds(values: np.ndarray, bins: int) -> list[np.ndarray]:
    """Split candidates of each column of values: between all distinct values, or where the ranks are nearest to even shares."""
    n, out = len(values), []
    most = max(min(bins, n) - 1, 0)
    for column in values.T:
        distinct, counts = np.unique(column, return_counts=True)
        between = (distinct[:-1] + distinct[1:]) / 2.0
        if len(between) <= most:
            out.append(between)
            continue
        # A split goes before the first value whose middle rank is beyond the share.
        upto = np.cumsum(counts).astype(float)
        middle = (upto[:-1] + upto[1:]) / 2.0
        stride = n / (most + 1)
        share, at, found = stride, 0, []
        while (at := max(at, int(np.searchsorted(middle, share, side="right")))) < len(middle):
            found.append(between[at])
            share, at = share + stride, at + 1
        out.append(np.array(found))
    return out


def bin_type(limits: Sequence[np.ndarray]) -> str:
    return "<u1" if max(map(len, limits), default=0) < 256 else "<u4"


def binned(values: np.ndarray, limits: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of each value (a row per feature): above the limit before it, up to its own."""
    codes = np.empty(values.shape, bin_type(limits))
    for j, limit in enumerate(limits):
        codes[j] = np.searchsorted(limit, values[j], side="left")
    return codes


def marks(parts: Sequence[int], ids: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1): Spark's pmod(xxhash64(parts..., id), 2^30) / 2^30, the parts as int and the id as bigint."""
    p1, p2, p3, p4, p5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    whole = (1 << 64) - 1
    turned = lambda x, r: (x << r | x >> (64 - r)) & whole
    seed = 42
    for part in parts:
        h = (seed + p5 + 4) & whole ^ (part & 0xFFFFFFFF) * p1 & whole
        h = (turned(h, 23) * p2 + p3) & whole
        h = (h ^ h >> 33) * p2 & whole
        h = (h ^ h >> 29) * p3 & whole
        seed = h ^ h >> 32
    u = np.uint64
    spun = lambda x, r: x << u(r) | x >> u(64 - r)
    h = u((seed + p5 + 8) & whole) ^ spun(ids.astype(np.int64).view(u) * u(p2), 31) * u(p1)
    h = spun(h, 27) * u(p1) + u(p4)
    h = (h ^ h >> u(33)) * u(p2)
    h = (h ^ h >> u(29)) * u(p3)
    h ^= h >> u(32)
    return (h & u((1 << 30) - 1)).astype(float) / (1 << 30)


def walked(values: np.ndarray, depth: int, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The value of each row in a complete binary tree; values has a row per feature."""
    at, rows = np.zeros(values.shape[1], np.intp), np.arange(values.shape[1])
    for _ in range(depth):
        at = 2 * at + 2 - (values[feature[at], rows] <= threshold[at])
    return value[at - (2**depth - 1)]


NAMES = ("features", "_y", "_fit", "_id", "_cur")
#: Blocks of rows: the features, all values of the first one first, as doubles or bins; the targets; which rows are fitted; numbers; predictions.
BLOCKS = "features binary, _y binary, _fit binary, _id binary, _cur binary"
#: Bytes of the features of a block, and blocks that pass between Spark and Python at once.
BLOCK_BYTES, BLOCKS_AT_ONCE = 256 << 10, 16


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Arrays of doubles as a matrix with a row per feature."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).T


@dataclass(frozen=True)
class Shape:
    """What the features of blocks are: their number, and bins between limits or else doubles."""

    width: int
    limits: Sequence[np.ndarray] | None = None

    def of(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, "<f8" if self.limits is None else bin_type(self.limits)).reshape(self.width, -1)


def packed(shape: Shape, start: float):
    """Rows (features, _y, _fit, _id) as blocks, with the first prediction."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = max(1, BLOCK_BYTES // (8 * shape.width))
        for batch in batches:
            for part in (batch.slice(i, many) for i in range(0, batch.num_rows, many)):
                values = matrix(part.column("features"), shape.width)
                values = np.ascontiguousarray(values) if shape.limits is None else binned(values, shape.limits)
                y, fit = part.column("_y").to_numpy(zero_copy_only=False), part.column("_fit").to_numpy(zero_copy_only=False)
                ids = part.column("_id").to_numpy(zero_copy_only=False)
                own = (values, y.astype("<f8"), fit.astype("?"), ids.astype("<i8"), np.full(len(y), start))
                yield pa.RecordBatch.from_pydict({c: pa.array([x.tobytes()], pa.binary()) for c, x in zip(NAMES, own, strict=True)})

    return made


def _blocks(batches: Iterator[pa.RecordBatch], shape: Shape) -> Iterator[list[np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            values, *rest = (batch.column(c)[i].as_buffer() for c in NAMES)
            yield [shape.of(values), *(np.frombuffer(x, kind) for x, kind in zip(rest, ("<f8", "?", "<i8", "<f8"), strict=True))]


def _after(values: np.ndarray, current: np.ndarray, trees: Sequence[tuple]) -> np.ndarray:
    for tree in trees:
        current = current + walked(values, *tree)
    return current


def advanced(shape: Shape, trees: Sequence[tuple], gradient: Callable, limits: Sequence[np.ndarray], draw: tuple | None):
    """Blocks of the rows that are fitted and drawn: bins of the features, and the gradient after the trees (depth, features, thresholds, values)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values, y, fit, ids, current in _blocks(batches, shape):
            on = fit if draw is None else fit & (marks(draw[0], ids) < draw[1])
            if not on.any():
                continue
            if not on.all():
                values, y, current = values[:, on], y[on], current[on]
            g = gradient(y, _after(values, current, trees))
            codes = values if shape.limits is not None else binned(values, limits)
            yield pa.RecordBatch.from_pydict({"features": pa.array([codes.tobytes()], pa.binary()), "_g": pa.array([g.astype("<f8").tobytes()], pa.binary())})

    return made


def drawn_rows(shape: Shape, draw: tuple):
    """Features of the fitted rows that are drawn."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values, _, fit, ids, _ in _blocks(batches, shape):
            on = fit & (marks(draw[0], ids) < draw[1])
            yield pa.RecordBatch.from_pydict({"features": pa.array([np.ascontiguousarray(values[:, on]).tobytes()], pa.binary())})

    return made


def targets(shape: Shape, trees: Sequence[tuple], tree: tuple | None, names: Sequence[str], fitted: bool):
    """Rows (_y, _cur after the trees, _leaf in `tree`, and under `names` the predictions after each of the trees)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values, y, fit, _, current in _blocks(batches, shape):
            on = fit == fitted
            values, y, current = values[:, on], y[on], current[on]
            each = []
            for t in trees:
                current = current + walked(values, *t)
                each.append(current)
            leaf = np.zeros(len(y), np.int32) if tree is None else walked(values, *tree).astype(np.int32)
            out = {"_y": pa.array(y, pa.float64(), from_pandas=True), "_cur": current, "_leaf": leaf}
            yield pa.RecordBatch.from_pydict(out | dict(zip(names, each, strict=False)))

    return made


def moved(shape: Shape, trees: Sequence[tuple]):
    """Blocks with the prediction after the trees."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            after = [_after(values, current, trees).tobytes() for values, *_, current in _blocks([batch], shape)]
            yield batch.set_column(batch.schema.get_field_index("_cur"), "_cur", pa.array(after, pa.binary()))

    return made


def _bin_sums(rows: DataFrame, splits: dict[int, tuple[int, int]], nodes: Sequence[int], columns: int, bins: int, kind: str, tasks: int) -> dict[int, np.ndarray]:
    """Of each of the nodes, all of one level: rows, sum and sum of squares per feature and bin. Nodes: 1, its children 2 and 3, and so on."""
    level = nodes[0].bit_length() - 1
    feature, last = np.full(1 << level, -1), np.zeros(1 << level, np.int64)
    for node, (j, k) in splits.items():
        if node < 1 << level:
            feature[node], last[node] = j, k
    place = np.full(2 << level, -1)
    place[list(nodes)] = range(len(nodes))
    def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, columns, len(nodes) * bins))
        for batch in batches:
            for i in range(batch.num_rows):
                codes = np.frombuffer(batch.column(0)[i].as_buffer(), kind).reshape(columns, -1)
                g = np.frombuffer(batch.column(1)[i].as_buffer(), "<f8")
                if np.isnan(g).any():
                    raise ValueError("labels must not be null or NaN")
                at, numbers = np.ones(len(g), np.intp), np.arange(len(g))
                for _ in range(level):
                    inside = np.minimum(at, len(feature) - 1)
                    j = np.where(at < len(feature), feature[inside], -1)
                    at = np.where(j >= 0, 2 * at + (codes[j, numbers] > last[inside]), at)
                slot = place[at]
                if (slot < 0).any():
                    codes, g, slot = codes[:, slot >= 0], g[slot >= 0], slot[slot >= 0]
                first, squares = slot * bins, g * g
                for j in range(columns):
                    cell = codes[j] + first
                    total[0, j] += np.bincount(cell, minlength=total.shape[2])
                    total[1, j] += np.bincount(cell, g, total.shape[2])
                    total[2, j] += np.bincount(cell, squares, total.shape[2])
        found = total.reshape(3, columns, len(nodes), bins)
        sums = [np.ascontiguousarray(found[:, :, i]).tobytes() for i in range(len(nodes))]
        yield pa.RecordBatch.from_pydict({"node": pa.array(list(nodes), pa.int64()), "sums": pa.array(sums, pa.binary())})

    def merged(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s) for s in group.column("sums").to_pylist())
        return pa.table({"node": pa.array([group.column("node")[0].as_py()], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "node bigint, sums binary"
    parts = rows.mapInArrow(added_up, schema)
    if tasks * len(nodes) * columns * bins * 24 > SUMS_BYTES:
        parts = parts.groupBy("node").applyInArrow(merged, schema)
    out = {}
    for node, sums in parts.collect():
        own = np.frombuffer(sums).reshape(3, columns, bins)
        out[node] = out[node] + own if node in out else own
    return out


def _impurity(stats: np.ndarray) -> np.ndarray:
    """Variance of rows, sums and sums of squares along the first axis; of no rows: 0."""
    n = np.where(stats[0] > 0, stats[0], 1.0)
    return np.where(stats[0] > 0, (stats[2] - stats[1] * stats[1] / n) / n, 0.0)


@dataclass
class _Node:
    stats: np.ndarray
    impurity: float
    gain: float = 0.0
    split: tuple[int, int] | None = None
    left: _Node | None = None
    right: _Node | None = None

    @property
    def prediction(self) -> float:
        return float(self.stats[1] / self.stats[0]) if self.stats[0] else 0.0

    def pruned(self) -> _Node:
        """Without splits into leaves of the same prediction."""
        if self.split is not None:
            self.left, self.right = self.left.pruned(), self.right.pruned()
            if self.left.split is None and self.right.split is None and self.left.prediction == self.right.prediction:
                return _Node(self.stats, self.impurity)
        return self


def _best_split(node: _Node, sums: np.ndarray, limits: Sequence[np.ndarray], least: int, least_weight: float, least_gain: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Sets the node's split and gain; the sums on its left and right. None: it stays a leaf."""
    best = None
    for j, limit in enumerate(limits):
        if not len(limit):
            continue
        upto = np.cumsum(sums[:, j, : len(limit) + 1], axis=1)
        left = upto[:, :-1]
        right = upto[:, -1:] - left
        both = left[0] + right[0]
        gain = node.impurity - left[0] / both * _impurity(left) - right[0] / both * _impurity(right)
        fewer = np.minimum(left[0], right[0])
        gain = np.where((fewer < least) | (fewer < least_weight) | (gain < least_gain), -np.inf, gain)
        k = int(np.argmax(gain))
        if best is None or gain[k] > best[0]:
            best = float(gain[k]), (j, k), left[:, k].copy(), right[:, k].copy()
    if best is None or not np.isfinite(best[0]):
        node.impurity = -1.0  # as Spark marks it
        return None
    if best[0] <= 0:
        return None
    node.gain, node.split = best[:2]
    return best[2:]


class DecisionTreeRegressor(regression.DecisionTreeRegressor):
    """Fits blocks of rows: `features`, their bins, and the target `_g`; `limits` are the thresholds between the bins.

    All parameters of Spark's tree that bear on a fit without weights of rows are kept.
    """

    limits: Sequence[np.ndarray] = ()

    def _fit(self, dataset: DataFrame) -> DecisionTreeRegressionModel:
        spark, limits = dataset.sparkSession, self.limits
        depth, columns, bins = self.getMaxDepth(), len(limits), max(map(len, limits), default=0) + 1
        many = max(1, SUMS_BYTES // (columns * bins * 24))
        tasks = dataset.rdd.getNumPartitions()
        splits: dict[int, tuple[int, int]] = {}
        open_, root, rows = {1: None}, None, 0.0
        for level in range(max(depth, 1)):
            below = {}
            wanted = sorted(open_)
            for some in (wanted[i : i + many] for i in range(0, len(wanted), many)):
                found = _bin_sums(dataset, splits, some, columns, bins, bin_type(limits), tasks)
                for number in some:
                    node = open_[number]
                    if node is None:
                        stats = found[number][:, 0].sum(axis=1) if found else np.zeros(3)
                        root = node = _Node(stats, float(_impurity(stats)))
                        if not (rows := stats[0]):
                            raise ValueError("a tree needs rows")
                    least = self.getMinInstancesPerNode(), self.getMinWeightFractionPerNode() * rows, self.getMinInfoGain()
                    sides = _best_split(node, found[number], limits, *least)
                    if sides is None:
                        continue
                    if level == depth:
                        node.split = None
                        continue
                    splits[number] = node.split
                    node.left, node.right = (_Node(s, float(_impurity(s))) for s in sides)
                    for child, side in ((2 * number, node.left), (2 * number + 1, node.right)):
                        if level + 1 < depth and abs(side.impurity) >= EPSILON:
                            below[child] = side
            if not (open_ := below):
                break
        model = DecisionTreeRegressionModel(_java_model(spark, self.uid, root.pruned(), limits))
        return self._copyValues(model)


def _java_model(spark: SparkSession, uid: str, root: _Node, limits: Sequence[np.ndarray]):
    """Spark's own model of these nodes."""
    context = spark.sparkContext
    ml, jvm = context._jvm.org.apache.spark.ml, context._jvm

    def made(node: _Node):
        stats = context._gateway.new_array(jvm.double, 3)
        for i, x in enumerate(node.stats):
            stats[i] = float(x)
        own = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, int(node.stats[0]))
        if node.split is None:
            return ml.tree.LeafNode(node.prediction, node.impurity, own)
        j, k = node.split
        return ml.tree.InternalNode(node.prediction, node.impurity, node.gain, made(node.left), made(node.right), ml.tree.ContinuousSplit(j, float(limits[j][k])), own)

    return ml.regression.DecisionTreeRegressionModel(uid, made(root), len(limits))
