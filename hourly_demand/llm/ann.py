"""Approximate nearest neighbours by balanced posting lists.

Fitting, on a bounded sample (SAMPLE rows in the order of a hash of the id): the sample is split in
halves of equal size, along the line between two means, until there is one part per LIST rows of
the table, MAX_LISTS at most. The means of the parts are the centroids, so lists are balanced. They
are linked to their nearest centroids and a few random ones; this graph is held in memory and
searched by a beam. Both it and the centroids are bounded and broadcast.

Index: every vector goes to the list of its nearest centroid, and a vector near a boundary also to
other lists whose distance is at most 1 + OVERLAP times as large, up to REPLICAS in all.

Search: a query looks into the lists whose centroids are at most `ratio` times as far as the nearest
one. The ratio is set on the sample so that a share TARGET of the true neighbours of sampled queries
lies in such lists. A list is cut into blocks of BLOCK vectors and its queries likewise, so a list
that holds a third of all rows is many tasks. Cosines are computed from the original vectors, row by
row, so equal vectors have equal scores wherever they lie. The nearest list of a query is searched
first; from the others only vectors come back that reach its k-th score there. A query with fewer than k results, which
takes a tiny table or an odd distribution, is compared with all blocks.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without
an id; vectors of different length are indexed apart. Rows with the query's id are the query's own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored
from .vectors import lists, matrix, usable

SAMPLE = 20_000
LIST = 256
MAX_LISTS = 16_384
REPLICAS = 4
OVERLAP = 0.05
TARGET = 0.95
#: Sampled queries that the ratio is set on.
PROBES = 256
BLOCK = 512
DEGREE = 16
RANDOM_LINKS = 4
#: Beam width when a vector is assigned.
BEAM = 24


class Index(NamedTuple):
    centroids: np.ndarray
    links: np.ndarray
    ratio: float
    beam: int


def unit(v: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very large or small components stay finite.
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the same row of b, in one order of summation."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _halves(v: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two parts of equal size along the line between two means."""
    means = v[rng.choice(len(v), 2, replace=False)]
    for _ in range(4):
        along = v @ (means[1] - means[0])
        order = np.argsort(along, kind="stable")
        halves = order[: len(v) // 2], order[len(v) // 2 :]
        means = np.stack([v[h].mean(axis=0) for h in halves])
    return halves


def centroids_of(v: np.ndarray, count: int) -> np.ndarray:
    """Means of equal parts of the rows of v."""
    rng, parts = np.random.default_rng(0), [v]
    while len(parts) < count:
        parts.sort(key=len)
        largest = parts.pop()
        if len(largest) < 2:
            parts.append(largest)
            break
        parts += [largest[h] for h in _halves(largest, rng)]
    return np.stack([p.mean(axis=0) for p in parts])


def graph_of(c: np.ndarray) -> np.ndarray:
    """For each centroid its nearest ones, its neighbours on a ring and some random ones."""
    n, rng = len(c), np.random.default_rng(1)
    near = min(DEGREE, n - 1)
    links = np.zeros((n, near + 2 + RANDOM_LINKS), np.int64)
    square = (c * c).sum(axis=1)
    for a in range(0, n, 1024):
        far = square[a : a + 1024, None] + square[None, :] - 2 * c[a : a + 1024] @ c.T
        far[np.arange(len(far)), np.arange(a, a + len(far))] = np.inf
        if near:
            links[a : a + 1024, :near] = np.argpartition(far, near - 1, axis=1)[:, :near]
    links[:, near], links[:, near + 1] = (np.arange(n) + 1) % n, (np.arange(n) - 1) % n
    links[:, near + 2 :] = rng.integers(0, n, (n, RANDOM_LINKS))
    return links


def beam_search(q: np.ndarray, c: np.ndarray, links: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of q the nearest centroids a beam of this width finds, nearest first, and their distances."""
    n, width = len(c), min(width, len(c))
    square, own = (c * c).sum(axis=1), (q * q).sum(axis=1)

    def distance(rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return own[rows, None] + square[nodes] - 2 * np.einsum("qd,qkd->qk", q[rows], c[nodes])

    seen = np.zeros((len(q), n), bool)
    start = np.unique(np.linspace(0, n - 1, min(n, 8)).astype(np.int64))
    ids = np.full((len(q), width + len(start)), -1)
    far = np.full(ids.shape, np.inf)
    ids[:, : len(start)] = start
    far[:, : len(start)] = distance(np.arange(len(q)), np.broadcast_to(start, (len(q), len(start))))
    seen[:, start] = True
    order = np.argsort(far, axis=1, kind="stable")[:, :width]
    ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
    done = far == np.inf
    while True:
        open_ = np.where(done, np.inf, far)
        at = open_.argmin(axis=1)
        rows = np.flatnonzero(open_[np.arange(len(q)), at] < np.inf)
        if not len(rows):
            return ids, np.sqrt(np.maximum(far, 0))
        done[rows, at[rows]] = True
        nodes = links[ids[rows, at[rows]]]
        new = ~np.take_along_axis(seen[rows], nodes, 1)
        # A node that two links lead to counts once.
        ranked = np.sort(nodes, axis=1)
        if (ranked[:, 1:] == ranked[:, :-1]).any():
            first = np.zeros(nodes.shape, bool)
            by = np.argsort(nodes, axis=1, kind="stable")
            fresh = np.concatenate((np.ones((len(rows), 1), bool), np.diff(np.take_along_axis(nodes, by, 1), axis=1) != 0), axis=1)
            np.put_along_axis(first, by, fresh, 1)
            new &= first
        seen[rows[:, None], nodes] = True
        d = np.where(new, distance(rows, nodes), np.inf)
        all_ids = np.concatenate((ids[rows], nodes), axis=1)
        all_far = np.concatenate((far[rows], d), axis=1)
        all_done = np.concatenate((done[rows], ~new), axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :width]
        ids[rows] = np.take_along_axis(all_ids, order, 1)
        far[rows] = np.take_along_axis(all_far, order, 1)
        done[rows] = np.take_along_axis(all_done, order, 1) | (far[rows] == np.inf)


def _chosen(ids: np.ndarray, far: np.ndarray, ratio: float) -> np.ndarray:
    """Which of the found lists are within the ratio of the nearest."""
    return (far < np.inf) & (far <= far[:, :1] * ratio + 1e-12)


def homes(v: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Lists of each vector, and which of them count."""
    ids, far = beam_search(v, index.centroids, index.links, BEAM)
    return ids[:, :REPLICAS], _chosen(ids, far, 1 + OVERLAP)[:, :REPLICAS]


def fit(sample: np.ndarray, rows: int, k: int) -> Index:
    """The index of a table of so many rows, from unit vectors of its sample."""
    count = int(np.clip(-(-rows // LIST), 1, min(MAX_LISTS, max(1, len(sample) // 8))))
    c = centroids_of(sample, count)
    index = Index(c, graph_of(c), 1.0, len(c))
    rng = np.random.default_rng(2)
    probes = rng.choice(len(sample), min(PROBES, len(sample)), replace=False)
    found = sample[probes] @ sample.T
    found[np.arange(len(probes)), probes] = -np.inf
    k = min(k, len(sample) - 1)
    if k < 1 or len(c) < 2:
        return index
    true = np.argpartition(-found, k - 1, axis=1)[:, :k]
    lists_of, member = homes(sample, index)
    to = np.sqrt(np.maximum(((sample[probes] ** 2).sum(axis=1))[:, None] + (c * c).sum(axis=1) - 2 * sample[probes] @ c.T, 0))
    needed = np.where(member[true], np.take_along_axis(to[:, None, :].repeat(k, 1), lists_of[true], 2), np.inf).min(axis=2)
    ratio = float(np.quantile(needed / np.maximum(to.min(axis=1), 1e-9)[:, None], TARGET))
    # The beam is as wide as the most lists any sampled query needs, and a bit more.
    most = int((to <= to.min(axis=1, keepdims=True) * ratio).sum(axis=1).max())
    return index._replace(ratio=ratio, beam=min(len(c), most + most // 4 + 8))


def _placed(table: DataFrame, shared, of_query: bool) -> DataFrame:
    """A row per list of each vector."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*shared.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                v = matrix(part.column("v"))
                u = unit(v)
                if of_query:
                    ids, far = beam_search(u, index.centroids, index.links, index.beam)
                    member = _chosen(ids, far, index.ratio)
                else:
                    ids, member = homes(u, index)
                row, col = np.nonzero(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row, col].astype(np.int32)), pa.array(col.astype(np.int32)), part.column("id").take(pa.array(row)), lists(v[row])],
                    names=["list", "place", "id", "v"],
                )

    return table.select("id", "v").mapInArrow(placed, "list int, place int, id bigint, v array<double>")


def _nearest(k: int):
    def nearest(queries: pa.Table, kept: pa.Table) -> pa.Table:
        """The k nearest of a block of vectors for each query of a block."""
        out = [], [], []
        if len(queries) and len(kept):
            q, v = matrix(queries["v"]), matrix(kept["v"])
            names, ids, floor = queries["id"].to_numpy(), kept["id"].to_numpy(), queries["floor"].to_numpy()
            near = unit(q) @ unit(v).T
            near[names[:, None] == ids[None, :]] = -np.inf
            # Rows of one id count once, by the best of them, so that they push no other id out.
            by = np.argsort(ids, kind="stable")
            heads = np.flatnonzero(np.diff(ids[by], prepend=ids[by[0]] - 1))
            best = near if len(heads) == len(ids) else np.maximum.reduceat(near[:, by], heads, axis=1)
            for i, row in enumerate(near):
                least = np.partition(best[i], -k)[-k] if best.shape[1] > k else -np.inf
                # Rounding differs with the place in a product: what comes near the k-th is scored anew.
                at = np.flatnonzero((row >= max(least, floor[i]) - 1e-9) & (row > -np.inf))
                if len(at):
                    score = cosine(np.broadcast_to(q[i], (len(at), q.shape[1])), v[at])
                    order = np.lexsort((ids[at], -score))
                    # Each id once, with its best score.
                    seen = np.unique(ids[at][order], return_index=True)[1]
                    order = order[np.sort(seen)][:k]
                    out[0].append(np.full(len(order), names[i]))
                    out[1].append(ids[at][order])
                    out[2].append(score[order])
        kinds = (np.int64, np.int64, np.float64)
        cols = [np.concatenate(x) if x else np.empty(0, t) for x, t in zip(out, kinds, strict=True)]
        return pa.table({"query_id": cols[0], "vec_id": cols[1], "score": cols[2]})

    return nearest


def _met(queries: DataFrame, kept: DataFrame, k: int) -> DataFrame:
    """Nearest vectors of each query in each block of the lists it is in. Columns list, id, v and, of
    queries, floor: lower scores are of no use."""
    size = kept.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("kb"))
    many = queries.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("qb"))
    cut = size.join(many, "list")
    at = ["list", "a", "b"]
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = queries.join(cut, "list").withColumn("a", own("qb")).withColumn("b", each("kb")).select(*at, "id", "v", "floor")
    two = kept.join(cut, "list").withColumn("b", own("kb")).withColumn("a", each("qb")).select(*at, "id", "v")
    return one.groupBy(at).cogroup(two.groupBy(at)).applyInArrow(_nearest(k), "query_id bigint, vec_id bigint, score double")


def _first(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search(table: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest found; ties to the smaller id."""
    spark = table.sparkSession
    nonzero = F.exists("v", lambda x: x != 0)
    good = stored(usable(table, key, vector).where(nonzero), "vectors")
    asked = usable(table.where(is_query), key, vector).where(nonzero).dropDuplicates(["id", "v"])
    asked = stored(asked, "queries")
    out = None
    for dim, rows in good.groupBy("dim").count().orderBy("dim").collect():
        kept, queries = good.where(F.col("dim") == dim), asked.where(F.col("dim") == dim)
        sample = kept.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("id", "v").toArrow()
        # Rows of one id are not each other's neighbours.
        sample = sample.take(pa.array(np.unique(sample["id"].to_numpy(), return_index=True)[1]))
        index = fit(unit(matrix(sample["v"])), rows, k)
        shared = spark.sparkContext.broadcast(tuple(index))
        posted = stored(_placed(kept, shared, False).drop("place"), "lists")
        looking = stored(_placed(queries, shared, True), "lookups")
        none = F.lit(float("-inf")).alias("floor")
        near = stored(_first(_met(looking.where("place = 0").select("list", "id", "v", none), posted, k), k), "nearest")
        floors = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        rest = looking.where("place > 0").join(floors, "id", "left").withColumn("floor", F.coalesce("floor", none))
        found = stored(_first(near.drop("rank").unionByName(_met(rest, posted, k)), k), "nearest")
        # Queries that found too few are compared with all vectors, in blocks.
        full = found.groupBy("query_id").count().where(F.col("count") >= min(k, rows - 1)).select("query_id")
        short = stored(queries.join(full, queries["id"] == full["query_id"], "left_anti"), "short")
        if not short.isEmpty():
            same = F.lit(0).alias("list")
            exact = _first(_met(short.select(same, "id", "v", none), kept.select(same, "id", "v"), k), k)
            found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(exact)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
