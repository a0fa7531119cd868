"""Exact top-k search by distributed selection on histograms.

Queries and candidates are cut into blocks; a task scores one block of queries against one block of
candidates, so nothing grows with the tables but the number of tasks. Scores are not kept. Instead,
every round counts them in bins and adds the counts up for each query over all blocks, which tells
the bin of the k-th best score; the next round bins the scores within that bin only, until a bin is
a single score. A block's histogram ends with the bin in which the block alone reaches k, as lower
bins cannot hold the k-th score. The last pass returns all scores above the k-th one and of those
equal to it the smallest ids, again at most k for each query and block, from which Spark takes the
first k by score and id.

Components are scaled and floored to integers, so scores are exact. Vectors that are null or hold
null or non-finite components take no part, nor do rows without an id; only vectors of the query's
length are its candidates; rows with the query's id are the query's own. A repeated query row gives
its results again. Scores are computed in 64 bits and wrap beyond.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored
from .vectors import block, blocks, matrix, usable

#: Rows of a block of candidates and of queries: 8 MB of scores in a task.
CANDIDATES = 4096
QUERIES = 256
BINS = 1024


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products as int64."""
    most = np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * max(1, queries.shape[-1])
    if most < 2**53:  # every partial sum is a whole number that a double holds
        return (queries @ candidates.T).astype(np.int64)
    wide = [np.clip(x, -(2.0**62), 2.0**62).astype(np.int64) for x in (queries, candidates)]
    return wide[0] @ wide[1].T


def _scored(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of a block, which of them count, and the candidates' ids."""
    ids = right["id"].to_numpy()
    found = scores(matrix(left["v"]), matrix(right["v"]))
    return found, left["query_id"].to_numpy()[:, None] != ids[None, :], ids


def _histograms(left: pa.Table, right: pa.Table) -> pa.Table:
    """For each query the bins of the block from the top to the one in which it reaches the need."""
    out = {"q": [], "bin": [], "n": []}
    if len(left) and len(right):
        found, counts, _ = _scored(left, right)
        cols = [left[c].to_numpy() for c in ("q", "lo", "width", "step", "need")]
        for row, ok, q, lo, width, step, need in zip(found, counts, *cols, strict=True):
            at = row[ok & (row >= lo) & (row < lo + width)] - lo
            bins, n = np.unique(at // step, return_counts=True)
            bins, n = bins[::-1], n[::-1]
            keep = int(np.searchsorted(np.cumsum(n), need)) + 1
            bins, n = bins[:keep], n[:keep]
            out["q"].append(np.full(len(bins), q))
            out["bin"].append(bins)
            out["n"].append(n)
    return pa.table({k: pa.array(np.concatenate(v) if v else np.empty(0, np.int64), pa.int64()) for k, v in out.items()})


def _winners(left: pa.Table, right: pa.Table) -> pa.Table:
    """Scores above the k-th, and the smallest ids of those equal to it."""
    out = {"q": [], "query_id": [], "vec_id": [], "score": []}
    if len(left) and len(right):
        found, counts, ids = _scored(left, right)
        cols = [left[c].to_numpy() for c in ("q", "query_id", "lo", "need")]
        for row, ok, q, query, lo, need in zip(found, counts, *cols, strict=True):
            above = np.flatnonzero(ok & (row > lo))
            equal = np.flatnonzero(ok & (row == lo))
            equal = equal[np.argsort(ids[equal], kind="stable")[:need]]
            both = np.concatenate((above, equal))
            out["q"].append(np.full(len(both), q))
            out["query_id"].append(np.full(len(both), query))
            out["vec_id"].append(ids[both])
            out["score"].append(row[both])
    return pa.table({k: pa.array(np.concatenate(v) if v else np.empty(0, np.int64), pa.int64()) for k, v in out.items()})


def _scaled(rows: DataFrame, scale: int) -> DataFrame:
    # Doubles beyond 2^53 are whole numbers, and a bigint could not hold all of them.
    whole = lambda y: F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)
    return rows.withColumn("v", F.transform("v", lambda x: whole(x * scale)))


def search(table: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k highest scores of each query, all if fewer;
    ties to the smaller id."""
    if k < 1:
        raise ValueError("k has to be positive")
    candidates = stored(_scaled(usable(table, key, vector), scale), "candidates")
    chosen = _scaled(usable(table.where(is_query), key, vector), scale)
    queries = stored(chosen.select(F.monotonically_increasing_id().alias("q"), F.col("id").alias("query_id"), "dim", "v"), "queries")
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    n, longest = candidates.agg(F.count(F.lit(1)), F.max(size)).first()
    many, own = queries.agg(F.count(F.lit(1)), F.max(size)).first()
    bound = math.ceil((longest or 0) * (own or 0) * (1 + 1e-9)) + 1
    bound = min(bound, 2**62)
    nc, nq = blocks(n, CANDIDATES), blocks(many, QUERIES)
    at = ["dim", "c", "b"]
    right = candidates.withColumn("c", block(nc)).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    left = queries.withColumn("b", F.pmod(F.xxhash64("q"), F.lit(nq)).cast("int")).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(nc - 1))))

    def meet(state: DataFrame, task, schema: str) -> DataFrame:
        return left.join(state, "q").groupBy(at).cogroup(right.groupBy(at)).applyInArrow(task, schema)

    # The k-th score of a query lies in [lo, lo + width); need of the scores there are still wanted.
    state = queries.select("q", F.lit(-bound).cast("bigint").alias("lo"), F.lit(2 * bound + 1).cast("bigint").alias("width"), F.lit(k).cast("bigint").alias("need"))
    width = 2 * bound + 1
    while width > 1:
        step = -(-width // BINS)
        now = state.withColumn("step", F.lit(step).cast("bigint"))
        sums = meet(now, _histograms, "q bigint, bin bigint, n bigint").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("q").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        reached = sums.withColumn("upto", F.sum("n").over(down)).join(now, "q").where("upto >= need")
        kth = reached.groupBy("q").agg(F.max(F.struct("bin", "n", "upto")).alias("x"))
        # A query with fewer than k candidates keeps its lowest bound, so all of them are above it.
        state = stored(
            now.join(kth, "q", "left").select(
                "q",
                F.when(F.col("x").isNull(), F.col("lo")).otherwise(F.col("lo") + F.col("x.bin") * step).alias("lo"),
                F.when(F.col("x").isNull(), F.lit(1)).otherwise(F.lit(step)).cast("bigint").alias("width"),
                F.when(F.col("x").isNull(), F.col("need")).otherwise(F.col("need") - F.col("x.upto") + F.col("x.n")).alias("need"),
            ),
            "kth",
        )
        width = step
    found = meet(state, _winners, "q bigint, query_id bigint, vec_id bigint, score bigint")
    first = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
