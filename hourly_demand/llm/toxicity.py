"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the 64-bit hashes of its words and their first 4, 5 and 6 bytes, its pairs of
neighbouring words and its pairs of words with one or two others between them; each counts once. Words are runs of ASCII letters and
digits and of non-ASCII bytes, A-Z in lower case. All of it is vector arithmetic over the bytes of
an Arrow batch.

The model is fitted on a bounded sample of the labelled rows (SAMPLE_ROWS rows and SAMPLE_BYTES
bytes of text, whichever is less, in the order of a hash of the key). FTRL-proximal takes the rows
one after another: every coordinate has a learning rate of its own, and the L1 penalty keeps a
weight at zero until its gradients add up. Features of fewer than MIN_ROWS sampled rows are left
out. What remains is a few thousand weights, small enough to broadcast; scoring is one pass over
all texts without a shuffle.

A null text is an empty one; an empty text gets the score of the bias alone. Without labels of both
kinds the score of every text is the share of toxic ones (0.5 if there is none at all). Repeated
rows stay, a key that is labelled twice is toxic if one label says so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import slices, text_bytes, with_columns

SAMPLE_ROWS = 6_000
SAMPLE_BYTES = 48 << 20
SAMPLE_TEXT = 1 << 20
MIN_ROWS = 5
PASSES = 20
#: The L1 penalty grows with the rows seen, so that it weighs the same for any number of labels.
ALPHA, BETA, L1_PER_ROW, L2 = 5.0, 1.0, 1 / 2000, 0.0
#: Starts of words that are features too.
STEMS = (4, 5, 6)
#: Words between the two of a pair.
SKIPS = (0, 1, 2)
THRESHOLD = 0.7
_PRIME = np.uint64(0x100000001B3)
_CODES = np.zeros(256, np.uint64)
for _b in range(256):
    _c = chr(_b).lower() if _b < 128 else ""
    _CODES[_b] = ord(_c) + 1 if _c.isalnum() else (_b + 1 if _b >= 128 else 0)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A full 64-bit mix of each value, with wrapping arithmetic."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_PRIME), -1, 1 << 64))
    up, down = np.full(n + 1, _PRIME, np.uint64), np.full(n + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all features of all texts, and the number of the text of each."""
    code = _CODES[data]
    inside = code > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = ends[:-1][ends[:-1] < len(data)]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    up, down = _powers(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(code * up[:-1], dtype=np.uint64)))
    # Bytes outside words add nothing, so the sum up to the next word is that of the word.
    words = _mixed((np.append(sums[starts[1:]], sums[-1]) - sums[starts]) * down[starts])
    text = np.searchsorted(ends, starts, side="right") - 1
    hashes, of = [words], [text]
    # A word ends before the first byte outside words; its starts of fixed length lie within it.
    ends_of = np.flatnonzero(inside & np.append(~inside[1:] | first[1:], True)) + 1
    for size in STEMS:
        long = np.flatnonzero(ends_of - starts > size)
        at = starts[long]
        # Far from the hash of any word: a small number added would make a word of a neighbouring first letter.
        salt = np.uint64(size * 0x9E3779B97F4A7C15 % 2**64)
        hashes.append(_mixed((sums[at + size] - sums[at]) * down[at] + salt))
        of.append(text[long])
    for skip in SKIPS:
        gap = skip + 1
        if len(words) > gap:
            same = text[gap:] == text[:-gap]
            hashes.append(_mixed(words[:-gap] * np.uint64(3) + words[gap:] * np.uint64(5) + np.uint64(skip + 1))[same])
            of.append(text[gap:][same])
    return np.concatenate(hashes), np.concatenate(of)


def _rows_of(texts: list[str]) -> Iterator[np.ndarray]:
    """Distinct features of each text, as sorted arrays."""
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        yield np.unique(features(data, np.array([0, len(data)]))[0])


def fit(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Features with a weight (sorted), their weights and the bias."""
    none = np.empty(0, np.uint64), np.empty(0, np.float64)
    share = float(labels.mean()) if len(labels) else 0.5
    if not 0 < share < 1:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return *none, float(np.log(share / (1 - share)))
    # How many rows have a feature, counted in buckets first: most features are in one row only.
    seen = np.zeros(1 << 24, np.uint16)
    low = np.uint64((1 << 24) - 1)
    for row in _rows_of(texts):
        seen[np.unique(row & low)] += 1
    rows = [row[seen[row & low] >= MIN_ROWS] for row in _rows_of(texts)]
    names, counts = np.unique(np.concatenate(rows), return_counts=True)
    names = names[counts >= MIN_ROWS]
    rows = [np.searchsorted(names, row[np.isin(row, names, assume_unique=True)]) for row in rows]
    size = len(names) + 1  # the last is the bias
    z, n = np.zeros(size), np.zeros(size)

    l1 = L1_PER_ROW * len(rows) * PASSES

    def weights(i):
        zi = z[i]
        w = (np.sign(zi) * l1 - zi) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) > l1, w, 0.0)

    for _ in range(PASSES):
        for row, label in zip(rows, labels, strict=True):
            i = np.append(row, size - 1)
            w = weights(i)
            gradient = 1 / (1 + np.exp(-min(max(w.sum(), -35.0), 35.0))) - label
            square = gradient * gradient
            z[i] += gradient - (np.sqrt(n[i] + square) - np.sqrt(n[i])) / ALPHA * w
            n[i] += square
    w = weights(np.arange(size))
    kept = np.flatnonzero(w[:-1])
    return names[kept], w[kept], float(w[-1])


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """The bounded sample: text and label, in the order of a hash of the key."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("_label"))
    # Labels without a document take no place in the sample; only keys are read for that.
    known = known.join(docs.select(key).distinct(), key, "left_semi")
    order = F.xxhash64(F.lit("toxicity"), F.col(key).cast("string"))
    chosen = known.orderBy(order, key).limit(SAMPLE_ROWS)
    found = docs.select(key, F.coalesce(text, F.lit("")).alias("_text")).join(F.broadcast(chosen), key)
    # Copies of a key may be many; the sample stays bounded.
    few = found.withColumn("_order", order).withColumn("_bytes", F.octet_length("_text"))
    # A text that is very long alone takes no part, so it cannot push out all after it.
    few = few.where(F.col("_bytes") <= SAMPLE_TEXT)
    few = few.orderBy("_order", "_bytes", "_text").limit(SAMPLE_ROWS)
    upto = F.sum("_bytes").over(Window.orderBy("_order", "_bytes", "_text").rowsBetween(Window.unboundedPreceding, 0))
    return few.withColumn("_upto", upto).where(F.col("_upto") <= SAMPLE_BYTES).select("_order", "_text", "_label")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"):
    """The model of the labelled rows: features, weights and bias. One task sees the bounded sample."""

    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_order", "_text"], kind="stable")
        names, w, bias = fit(rows["_text"].tolist(), rows["_label"].to_numpy(np.float64))
        return pd.DataFrame({"feature": np.append(names.view(np.int64), 0), "weight": np.append(w, bias), "bias": np.append(np.zeros(len(w), bool), True)})

    chosen = sample(docs, labels, key, text, label)
    model = chosen.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(fitted, "feature bigint, weight double, bias boolean").toPandas()
    bias = model.loc[model["bias"], "weight"]
    kept = model[~model["bias"]].sort_values("feature")
    names = kept["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(names)
    return names[order], kept["weight"].to_numpy()[order], float(bias.iloc[0]) if len(bias) else 0.0


def score(docs: DataFrame, model, text: str = "text", name: str = "score") -> DataFrame:
    """docs with the probability that the text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [f for f in docs.schema.fields if f.name != name]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, bias = shared.value
        # Most features have no weight: a table of some bits of the hash tells so for nearly all.
        may = np.zeros(1 << 18, bool)
        bits = np.uint64((1 << 18) - 1)
        may[names & bits] = True
        for batch in batches:
            for part in slices(batch, text, 1 << 20):
                hashes, of = features(*text_bytes(part.column(text)))
                hit = np.flatnonzero(may[hashes & bits])
                place = np.searchsorted(names, hashes[hit])
                good = place < len(names)
                good[good] = names[place[good]] == hashes[hit[good]]
                # A feature counts once in a text.
                once = np.unique(of[hit[good]] * np.int64(len(names) + 1) + place[good])
                text_of, which = np.divmod(once, len(names) + 1)
                total = bias + np.bincount(text_of, weights[which], part.num_rows)
                value = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
                yield with_columns(part, {name: pa.array(value, pa.float64())})

    return docs.mapInArrow(scored, T.StructType([*fields, T.StructField(name, T.DoubleType())]))


def held_out(key: Column) -> Column:
    """Rows that no label is learned from: crc32 of the key as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """docs with held_out, score and predicted (1 from THRESHOLD on)."""
    model = train(docs, labels.where(~held_out(F.col(key))), key, text, label)
    found = score(docs.drop("held_out", "predicted"), model, text)
    return found.withColumns({"held_out": held_out(F.col(key)), "predicted": F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)})
