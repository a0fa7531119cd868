"""Keyed bijections and the importances built on them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourly_demand.operators import permutation
from hourly_demand.plans import importance


def network(x, a, b, keys):
    l, r = divmod(x, b)
    mixed = lambda v, k: ((v + k[0]) % permutation.PRIME) ** 2 % permutation.PRIME * k[1] + k[2]
    for k in range(permutation.ROUNDS):
        own = keys[3 * k : 3 * k + 3]
        if k % 2 == 0:
            l = (l + mixed(r, own) % permutation.PRIME) % a
        else:
            r = (r + mixed(l, own) % permutation.PRIME) % b
    return l * b + r


def plain(n, keys):
    root = max(1, int(n**0.5))
    _, _, a, b = min((a * -(-n // a) - n, -a, a, -(-n // a)) for a in range(max((root + 1) // 2, root - permutation.WIDTHS + 1), root + 1))
    out = []
    for x in range(n):
        x = network(x, a, b, keys)
        while x >= n:
            x = network(x, a, b, keys)
        out.append(x)
    return out


SIZES = [1, 2, 3, 5, 7, 12, 97, 168, 600, 1009, 8191]


@pytest.fixture(scope="module")
def taken(spark):
    keys = permutation.round_keys(42, 1)
    rows = spark.createDataFrame([(n,) for n in SIZES], "n bigint").withColumn("size", permutation.shape(F.col("n")))
    rows = rows.withColumn("pos", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    literal = F.lit(keys).cast("array<bigint>")
    got = rows.select("n", "pos", permutation.partner(F.col("pos"), F.col("n"), F.col("size"), literal).alias("to")).toPandas()
    return keys, {n: part.sort_values("pos")["to"].tolist() for n, part in got.groupby("n")}


def test_bijection_of_any_size(taken):
    keys, found = taken
    for n in SIZES:
        assert sorted(found[n]) == list(range(n)) and found[n] == plain(n, keys), n


def test_it_looks_like_a_shuffle(taken):
    _, found = taken
    for n in (1009, 8191):
        to = np.array(found[n])
        assert abs(np.corrcoef(np.arange(n), to)[0, 1]) < 0.1
        # Neighbours do not stay neighbours, and few rows stay where they are.
        steps = np.diff(to)
        assert np.unique(steps).size > 0.5 * n and (to == np.arange(n)).sum() < 10
        assert abs(np.corrcoef(to[:-1], to[1:])[0, 1]) < 0.1
    assert permutation.round_keys(1, 2) != permutation.round_keys(1, 3)


def test_permutation_importance_equals_numpy(spark):
    rng = np.random.default_rng(1)
    rows = []
    for zone, n in ((1, 97), (None, 53)):
        rows += [(zone, i, float(v), float(w), float(i % 5)) for i, (v, w) in enumerate(rng.normal(size=(n, 2)))]
    made = spark.createDataFrame(rows, "zone_id bigint, i int, lag_1 double, lag_2 double, trips_count double")
    table = made.withColumn("pickup_hour", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, i)")).drop("i")
    predict = lambda df: df.withColumn("prediction", F.col("lag_1") + 2 * F.col("lag_2") * F.col("lag_2"))
    got = {r["feature"]: r for r in importance.permutation_importance(table, predict, ["lag_1", "lag_2"], ["zone_id"], repeats=3, seed=9).collect()}
    zones = [[r for r in rows if r[0] == z] for z in (1, None)]
    error = lambda r, a, b: abs(r[4] - (a + 2 * b * b))
    base = np.mean([error(r, r[2], r[3]) for z in zones for r in z])
    for feature, at in (("lag_1", 2), ("lag_2", 3)):
        rises = []
        for repeat in range(3):
            errors = []
            for z in zones:
                for r, j in zip(z, plain(len(z), permutation.round_keys(9, repeat)), strict=True):
                    errors.append(error(r, z[j][2] if at == 2 else r[2], z[j][3] if at == 3 else r[3]))
            rises.append(np.mean(errors) - base)
        assert got[feature]["mae_increase"] == pytest.approx(np.mean(rises))
        assert got[feature]["std"] == pytest.approx(np.std(rises))
