"""op4 against brute force; op7 for recall and exact scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourly_demand.llm import ann, topk

SCHEMA = "vec_id bigint, embedding array<float>, query_id string"
ODD = [
    (9000, None), (9001, []), (9002, [None, 1.0, 0.0, 0.0]), (9003, [float("nan"), 1.0, 0.0, 0.0]),
    (9004, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0, 0.0]), (9050, [1.0, 2.0]), (9051, [2.0, 1.0]), (9100, None),
]


def table(spark, rows):
    return spark.createDataFrame([(i, v, "old") for i, v in rows], SCHEMA)


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim).astype(np.float32).tolist()) for i in range(n)]
    same = rows[3][1]
    return rows + [(n + k, same) for k in range(30)] + [(50 * k + 100_000, same) for k in range(3)]


def usable(rows):
    return [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]


def brute_topk(rows, k):
    good = usable(rows)
    out = set()
    for q, v in good:
        if q % 50 == 0:
            mine = [math.floor(256 * float(np.float32(x))) for x in v]
            found = []
            for c, w in good:
                if c != q and len(w) == len(v):
                    found.append((-sum(a * math.floor(256 * float(np.float32(x))) for a, x in zip(mine, w, strict=True)), c))
            out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(sorted(found)[:k])}
    return out


@pytest.mark.parametrize("k", [1, 5, 200])
def test_topk(spark, monkeypatch, k):
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rows = vectors(120, 4, 1) + ODD
    got = topk.search(table(spark, rows), F.col("vec_id") % 50 == 0, k=k)
    assert {tuple(r) for r in got.collect()} == brute_topk(rows, k)


def test_topk_of_large_and_equal_scores(spark):
    rows = [(i, [1000.0, -2.5e5, 0.0, 1e-30]) for i in range(0, 200, 10)] + [(7, [-1e-30, 0.0, 0.0, 0.0])]
    got = topk.search(table(spark, rows), F.col("vec_id") % 50 == 0, k=3)
    assert {tuple(r) for r in got.collect()} == brute_topk(rows, 3)


def test_scores_beyond_doubles():
    a = np.array([[2.0**40, 1.0]])
    assert topk.scores(a, np.array([[2.0**20, 1.0]])).tolist() == [[2**60 + 1]]


def test_empty_tables(spark):
    for rows in ([], [(50, None)], [(1, [1.0, 2.0])]):
        assert topk.search(table(spark, rows), F.col("vec_id") % 50 == 0).count() == 0
        assert ann.search(table(spark, rows), F.col("vec_id") % 50 == 0).count() == 0


def brute_nearest(rows, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in usable(rows) if any(v)]
    out = {}
    for q, v in good:
        if q % 50 == 0:
            found = sorted((-(v @ w) / (math.sqrt(v @ v) * math.sqrt(w @ w)), c) for c, w in good if c != q and len(w) == len(v))
            out[q] = found[:k]
    return out


@pytest.mark.parametrize("copies", [2, 7])
def test_ann_of_repeated_rows(spark, monkeypatch, copies):
    monkeypatch.setattr(ann, "LIST", 10_000)  # one list: exact
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(60)]
    got = ann.search(table(spark, rows * copies), F.col("vec_id") % 50 == 0, k=5).collect()
    want = {(q, c) for q, found in brute_nearest(rows, 5).items() for _, c in found}
    assert {(r["query_id"], r["vec_id"]) for r in got} == want and len(got) == len(want)


def test_ann(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST", 32)
    monkeypatch.setattr(ann, "BLOCK", 16)
    rows = vectors(1500, 8, 2) + [*ODD, (9200, [0.0] * 8)]
    got = ann.search(table(spark, rows), F.col("vec_id") % 50 == 0, k=5).collect()
    want = brute_nearest(rows, 5)
    mine = {}
    for r in got:
        mine.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(mine) == {q for q in want if want[q]}
    data = {i: np.array(v, np.float32).astype(float) for i, v in usable(rows)}
    hits = total = 0
    for q, found in mine.items():
        assert sorted(found) == list(range(1, len(found) + 1)) and len(found) == len(want[q])
        order = [(-s, c) for c, s in (found[r] for r in sorted(found))]
        assert order == sorted(order)
        for c, s in found.values():
            a, b = data[q], data[c]
            assert s == pytest.approx((a @ b) / (math.sqrt(a @ a) * math.sqrt(b @ b)), abs=1e-12)
        hits += sum(s >= -want[q][-1][0] - 1e-9 for _, s in found.values())
        total += len(found)
    assert hits >= 0.9 * total
    # Equal vectors: the smallest ids come first.
    assert [found[0] for _, found in sorted(mine[100_000].items())] == [3, 1500, 1501, 1502, 1503]


def test_beam_search_finds_nearest():
    rng = np.random.default_rng(0)
    c, q = ann.unit(rng.normal(size=(400, 16))), ann.unit(rng.normal(size=(50, 16)))
    ids, far = ann.beam_search(q, c, ann.graph_of(c), 64)
    exact = np.sqrt(((q[:, None] - c[None]) ** 2).sum(axis=2))
    assert (np.diff(far, axis=1) >= 0).all()
    assert (ids[:, 0] == exact.argmin(axis=1)).mean() > 0.95
    assert np.allclose(far, np.take_along_axis(exact, ids, 1))


def test_lists_are_balanced():
    rng = np.random.default_rng(0)
    v = np.concatenate((rng.normal(size=(300, 4)), np.ones((700, 4))))
    parts = ann.centroids_of(v, 16)
    assert len(parts) == 16


def test_repeated_queries(spark):
    rng = random.Random(1)
    rows = [(i, [rng.random() for _ in range(4)]) for i in range(60)]
    twice = topk.search(table(spark, [*rows, rows[50]]), F.col("vec_id") % 50 == 0, k=2)
    assert twice.where("query_id = 50").count() == 4
