"""SimHash near-duplicate detection with multi-index hashing.

Every text becomes a 64-bit fingerprint of its word shingles. Two fingerprints are linked if they
differ in few bits; documents reachable from each other form a component.

The 64 bits are cut into segments with a radius each. If the radii + 1 add up to more than the
distance, two linked fingerprints differ by no more than the radius in at least one segment. So each
distinct fingerprint is entered in one table per segment under its value there, and looked up under
all values of the small Hamming ball around it; matches are verified by their whole distance.

Equal fingerprints are one node from the start, so exact copies cost nothing. A bucket that many
lookups of different fingerprints meet in, as a large group of near copies makes, is not joined: its
members are dealt out in blocks, and a task that holds a block of each side returns only a spanning
set of the links it verified, so no such group is turned into its pairs, and none is gathered.

Fingerprints are few bytes each, and Spark sizes their lookups, some 50 rows of each, as if they had not
been exploded. It would broadcast them for any corpus of less than some GB, so all joins are sorted ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.groups import BROADCAST_ROWS, unbroadcast
from .common import slices, stored, text_bytes
from .components import components

#: (first bit, bits, radius) of each segment, for a distance of 4: 2 + 2 + 1 > 4.
SEGMENTS = ((0, 22, 1), (22, 22, 1), (44, 20, 0))
#: Entries x lookups of a bucket that the join still turns into pairs.
JOINED = 64
#: Members of each side that a task of a larger bucket holds.
BLOCK = 2048
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint_of(text: bytes, shingle: int, seed: int = 42) -> int:
    """64 bits; a bit is set if it is in over half of the XXH64 of all shingles. No words: 0."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.translate(_LOWER))
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    # Shingles are runs of the words joined by single blanks.
    runs = zip(starts, ends.tolist()[min(shingle, len(words)) - 1 :], strict=False)
    votes, total = np.zeros(64, np.int64), 0
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in runs), dtype="<u8")
    for part in np.array_split(hashes, len(hashes) // 50_000 + 1):  # bounded memory for long texts
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(part)
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, text: str = "text") -> DataFrame:
    """docs without the text, and its fingerprint fp as a (signed) bigint."""
    kept = [f for f in docs.schema.fields if f.name not in (text, "fp")]
    names = [f.name for f in kept]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                data, ends = text_bytes(part.column(text))
                whole = data.tobytes()
                values = [fingerprint_of(whole[a:b], shingle) for a, b in zip(ends, ends[1:], strict=False)]
                found = pa.array(np.array(values, dtype="<u8").view("<i8"), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [found], names=[*names, "fp"])

    return docs.mapInArrow(mapped, T.StructType([*kept, T.StructField("fp", T.LongType())]))


def _segment(fp: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1))


def _entries(nodes: DataFrame, segments) -> DataFrame:
    """Each fingerprint under its value in each segment."""
    return nodes.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(k).alias("segment"), _segment(F.col("fp"), a, b).alias("value")) for k, (a, b, _) in enumerate(segments)])).alias("at")
    ).select("fp", "at.*")


def _lookups(nodes: DataFrame, segments) -> DataFrame:
    """Each fingerprint under all values of the balls around its segments."""
    balls = []
    for k, (first, bits, radius) in enumerate(segments):
        masks = [0]
        for _ in range(radius):
            masks = sorted({m ^ (1 << b) for m in masks for b in range(bits)} | set(masks))
        balls.append(F.transform(F.lit(masks).cast("array<bigint>"), _flipped(k, _segment(F.col("fp"), first, bits))))
    return nodes.select("fp", F.explode(F.flatten(F.array(*balls))).alias("at")).select("fp", "at.*")


def _flipped(k: int, value: Column):
    return lambda mask: F.struct(F.lit(k).alias("segment"), value.bitwiseXOR(mask).alias("value"))


def links(nodes: DataFrame, distance: int = 4, segments=SEGMENTS) -> DataFrame:
    """Pairs a, b of fingerprints (column fp of nodes, distinct) that connect exactly what pairs of at
    most so many different bits connect. All such pairs, but for large buckets a spanning set of them."""
    if sum(r + 1 for *_, r in segments) <= distance or sum(b for _, b, _ in segments) != 64:
        raise ValueError("the segments have to cover 64 bits, and their radii + 1 to exceed the distance")
    entries = _entries(nodes, segments)
    sizes = entries.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("entries"))
    # Lookups that meet some other fingerprint.
    met = stored(
        unbroadcast(_lookups(nodes, segments)).join(unbroadcast(sizes), ["segment", "value"]), "lookups"
    )
    loads = met.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("lookups"), F.first("entries").alias("entries"))
    loads = stored(loads.where("lookups > 1"), "loads")
    small = loads.where(F.col("lookups") * F.col("entries") <= JOINED).select("segment", "value")
    left = met.join(unbroadcast(small), ["segment", "value"]).select("segment", "value", F.col("fp").alias("a"))
    right = entries.select("segment", "value", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = unbroadcast(left).join(unbroadcast(right), ["segment", "value"]).where((F.col("a") != F.col("b")) & near).select("a", "b")
    large = loads.where(F.col("lookups") * F.col("entries") > JOINED).withColumns(
        {"nl": F.ceil(F.col("lookups") / BLOCK).cast("int"), "ne": F.ceil(F.col("entries") / BLOCK).cast("int")}
    ).drop("lookups", "entries")
    # Few as a rule; then the rows of a very large bucket stay where they are.
    large = F.broadcast(large) if large.count() <= BROADCAST_ROWS else unbroadcast(large)
    # A block of one side meets each block of the other once.
    at = ["segment", "value", "l", "e"]
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")
    one = met.drop("entries").join(large, ["segment", "value"]).withColumn("l", own("nl")).withColumn("e", each("ne"))
    two = entries.join(large, ["segment", "value"]).withColumn("e", own("ne")).withColumn("l", each("nl"))

    def span(key, lookups: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
        return spanning(lookups["fp"].to_numpy(), kept["fp"].to_numpy(), distance)

    cols = [*at, "fp"]
    spanned = one.select(cols).groupBy(at).cogroup(two.select(cols).groupBy(at)).applyInPandas(span, "a long, b long")
    return pairs.unionByName(spanned)


def spanning(lookups: np.ndarray, kept: np.ndarray, distance: int) -> pd.DataFrame:
    """Links between members of two blocks that connect what all their near pairs connect."""
    nodes = np.unique(np.concatenate((lookups, kept)))
    left, right = np.unique(lookups), np.unique(kept)
    label = {n: n for n in nodes.tolist()}

    def root(n: int) -> int:
        while label[n] != n:
            label[n] = n = label[label[n]]
        return n

    out = []
    bits = right.view(np.uint64)
    for a in left.tolist():
        near = right[np.bitwise_count(bits ^ np.int64(a).view(np.uint64)) <= distance]
        for b in near.tolist():
            x, y = root(a), root(b)
            if x != y:
                label[max(x, y)] = min(x, y)
                out.append((a, b))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _components_of(rows: DataFrame, distance: int, segments) -> DataFrame:
    """fp and root, the smallest fingerprint of its component, for all fingerprints of rows."""
    nodes = rows.select("fp").distinct()
    found = components(links(nodes, distance, segments)).withColumnsRenamed({"node": "fp"})
    return unbroadcast(stored(nodes.join(unbroadcast(found), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "near-components"))


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, key: str = "doc_id", text: str = "text", segments=SEGMENTS) -> DataFrame:
    """One row per row of docs: key, fp and component_id, the smallest key reachable, itself included.

    Null and blank texts have fingerprint 0 and are linked like others. Rows with a null key belong
    to a component; its id is null only if no row of it has a key. Repeated rows stay.
    """
    rows = stored(fingerprints(docs.select(key, text), shingle, text), "fingerprints")
    reached = _components_of(rows, distance, segments)
    lows = rows.groupBy("fp").agg(F.min(key).alias("low")).join(reached, "fp")
    lowest = lows.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = reached.join(lowest, "root").select("fp", "component_id")
    return rows.join(unbroadcast(ids), "fp").select(key, "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, distance: int = 4, key: str = "doc_id", text: str = "text", segments=SEGMENTS) -> DataFrame:
    """docs with one row of each component: the one with the smallest key (nulls last), then text hash."""
    marked = docs.withColumn("_text", F.xxhash64(text))
    rows = stored(fingerprints(marked.select(key, "_text", text), shingle, text), "fingerprints")
    own = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("_text").alias("text"))
    of_fp = rows.groupBy("fp").agg(F.min(own).alias("low"), F.count(F.lit(1)).alias("n"))
    kept = of_fp.join(_components_of(rows, distance, segments), "fp").groupBy("root").agg(F.min("low").alias("low"))
    kept = stored(kept.select(F.col("low.key").alias("_key"), F.col("low.text").alias("_hash")).distinct(), "kept")
    chosen = marked.join(unbroadcast(kept), marked[key].eqNullSafe(kept["_key"]) & (marked["_text"] == kept["_hash"]), "left_semi")
    # Rows that are the same in key and text are copies; most tables have none, and then no text moves.
    same = rows.groupBy(key, "_text").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not same.isEmpty():
        chosen = chosen.dropDuplicates([key, "_text"])
    return chosen.drop("_text")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
