"""Ranked lexical search over bit-sliced Bloom signatures.

Index. Texts are read once. Every document gets a Bloom filter of its terms; a term that occurs tf
times is entered once per level j with 2^j <= tf. Documents are put in blocks of filters of equal
width, wide enough for each (WIDTH_BITS bits an entry), and a block is stored by bit: slice b holds
bit b of all its documents, the document-row bitmap. Beside it stand the documents' hashes, numbers
of terms and largest tf, and the block's dictionary of terms with document frequencies.

Search, for a bounded number of items at a time.

1. N, L and the document frequencies come from the index. The AND of a term's slices overestimates
   which documents of a block hold it so often. With tf < 2^(j+1) at the highest level found, the
   weighted sums of the bitmaps by level, times what a level adds at most at the document's length,
   bound every score from above. Each task returns its PILOTS highest bounds an item.
2. The pilots with the highest bounds of all are scored exactly. The k-th exact score of an item is
   a proven lower bound of its k-th result.
3. All documents whose upper bound reaches it are read again and scored exactly: what is left out
   is provably worse. So wrong bits and hash collisions only cost time.

An item's terms, weights and scores are integers, exact at any size. Rows of docs that repeat are
documents of their own; equal scores order by key, nulls last. Null and empty texts have no terms and
are not found. Items without terms, or whose terms no document holds, give no rows; equal item rows
are one. Empty tables give no rows. Extra columns are not looked at.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import slices, stored

#: Bits of a filter per entry, and bits that an entry sets.
WIDTH_BITS = 12
HASHES = 4
#: Documents, (document, term) pairs and bits of a block at most; a longer document is a block alone.
BLOCK_DOCS = 4096
BLOCK_PAIRS = 1 << 20
BLOCK_BITS = 1 << 23
#: Items, and their distinct terms, of one pass over the index; an item of more terms has its own pass.
ITEMS = 512
TERMS = 8192
#: Documents scored first, per item and result.
PILOTS = 4
#: (item, document) pairs whose documents are sent to the tasks that read texts; more are joined.
SENT = 1 << 20
PIECE = 4 << 20
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
INDEX = "width int, row array<bigint>, n array<bigint>, most array<int>, slices binary, terms array<string>, df array<int>"


def term_counts(text: bytes) -> Counter:
    """How often each term occurs: runs of letters and digits of ASCII and of all other characters."""
    counts: Counter = Counter()
    start = 0
    while start < len(text):
        stop = start + PIECE
        if stop < len(text):  # a long text in pieces that end between terms
            plain = text[start:stop].translate(_TERM)
            cut = plain.rfind(b" ")
            while cut < 0:
                stop += PIECE
                plain = text[start:stop].translate(_TERM)
                cut = plain.rfind(b" ") if stop < len(text) else len(plain)
        else:
            plain = text[start:].translate(_TERM)
            cut = len(plain)
        counts.update(plain[:cut].split())
        start += cut + 1
    return counts


def _places(hashes: np.ndarray, level: np.ndarray | int, width: int) -> Iterator[np.ndarray]:
    """The bits that entries of these terms at a level set in a filter of this width."""
    x = hashes + np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, np.uint64)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    step = (x >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        yield ((x + np.uint64(i) * step) & np.uint64(width - 1)).astype(np.int64)


def _hashes(terms) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(terms))


class _Window:
    """Documents that are gathered until they are put into blocks."""

    def __init__(self):
        self.rows: list[int] = []
        self.ids: list[list[int]] = []
        self.tfs: list[list[int]] = []
        self.pairs = 0
        self.vocabulary: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)

    def add(self, row: int, counts: Counter) -> None:
        self.rows.append(row)
        self.ids.append([self.vocabulary[t] for t in counts])
        self.tfs.append(list(counts.values()))
        self.pairs += len(counts)

    def full(self) -> bool:
        return len(self.rows) >= BLOCK_DOCS or self.pairs >= BLOCK_PAIRS

    def blocks(self) -> Iterator[tuple]:
        sizes = np.array([len(i) for i in self.ids])
        ids = np.fromiter(itertools.chain.from_iterable(self.ids), np.int64, self.pairs)
        tf = np.fromiter(itertools.chain.from_iterable(self.tfs), np.int64, self.pairs)
        terms = list(self.vocabulary)
        hashes, df = _hashes(terms), np.bincount(ids, minlength=len(terms))
        rows, heads = np.array(self.rows), np.concatenate(([0], np.cumsum(sizes)[:-1]))
        levels = np.frexp(tf)[1]  # of tf = 1: 1, of 2 and 3: 2
        n, most = np.add.reduceat(tf, heads), np.maximum.reduceat(tf, heads)
        need = np.add.reduceat(levels, heads) * WIDTH_BITS
        widths = 1 << np.ceil(np.log2(np.maximum(need, 64))).astype(np.int64)
        dictionary = ([t.decode() for t in terms], df)
        for width in np.unique(widths).tolist():
            of = np.flatnonzero(widths == width)
            most_docs = max(8, BLOCK_BITS // width)
            for part in np.array_split(of, -(-len(of) // most_docs)):
                at = np.concatenate([np.arange(heads[d], heads[d] + sizes[d]) for d in part])
                column = np.repeat(np.arange(len(part)), sizes[part])
                entry = np.repeat(np.arange(len(at)), levels[at])
                level = np.arange(len(entry)) - np.repeat(np.cumsum(levels[at]) - levels[at], levels[at])
                bits = np.zeros((width, -(-len(part) // 8) * 8), bool)
                for place in _places(hashes[ids[at]][entry], level, width):
                    bits[place, column[entry]] = True
                packed = np.packbits(bits, axis=1, bitorder="little").tobytes()
                yield width, rows[part], n[part], most[part], packed, *dictionary
                dictionary = (None, None)


def index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored blocks of signatures of all documents that have a term."""

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = _Window()
        for batch in batches:
            for part in slices(batch, "text"):
                for row, t in zip(part.column("row").to_pylist(), part.column("text"), strict=True):
                    counts = term_counts(t.as_buffer().to_pybytes()) if t.is_valid else None
                    if not counts:
                        continue
                    window.add(row, counts)
                    if window.full():
                        yield from map(_batch, window.blocks())
                        window = _Window()
        if window.rows:
            yield from map(_batch, window.blocks())

    return stored(_rows(docs, key, text).select("row", "text").mapInArrow(built, INDEX), "signatures")


def _batch(block: tuple) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int32())]
    names = ["width", "row", "n", "most", "slices", "terms", "df"]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(block, kinds, strict=True)], names=names)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, text and row, a hash of both. Rows of equal hash are scored apart from each other."""
    return docs.select(F.col(key).alias("key"), F.xxhash64(key, text).alias("row"), F.col(text).alias("text"))


@dataclass
class Items:
    """Items of one pass: their terms with weights (repeats included), and the corpus's sizes."""

    places: list[int]
    weights: list[dict[bytes, int]]
    documents: int
    total: int

    def length(self, n):
        """m of documents with n terms."""
        return 25 + (75 * n * self.documents) // self.total

    def score(self, item: int, counts: Counter, m: int) -> int:
        return sum(w * (10**9 * tf // (1000 * tf + 8 * m)) for t, w in self.weights[item].items() if (tf := counts.get(t)))


class Bounds:
    """Upper bounds of the scores of the items of one pass, for blocks of documents."""

    def __init__(self, items: Items):
        self.items = items
        terms = sorted({t for w in items.weights for t in w})
        number = {t: i for i, t in enumerate(terms)}
        self.hashes = _hashes(terms)
        self.weights = np.zeros((len(items.weights), len(terms)))
        for i, weights in enumerate(items.weights):
            for t, w in weights.items():
                self.weights[i, number[t]] = w

    def of(self, width: int, n: np.ndarray, most: np.ndarray, packed: bytes) -> np.ndarray:
        """By item and document of the block."""
        sliced = np.frombuffer(packed, np.uint8).reshape(width, -1)
        m = self.items.length(n).astype(float)
        out, found, before = np.zeros((len(self.weights), len(n))), None, np.zeros(len(n))
        for level in range(int(most.max()).bit_length()):
            here = None
            for place in _places(self.hashes, level, width):
                here = sliced[place] if here is None else here & sliced[place]
            # A term is at a level only if it is at all below.
            found = here if found is None else found & here
            if not found.any():
                break
            tf = np.minimum((2 << level) - 1, most).astype(float)
            reached = 1e9 * tf / (1000 * tf + 8 * m)
            held = np.unpackbits(found, axis=1, count=len(n), bitorder="little")
            out += (self.weights @ held) * np.maximum(reached - before, 0)
            before = np.maximum(reached, before)
        return out * (1 + 1e-9) + 1 * (out > 0)


def _prepared(items: DataFrame, item: str, text: str, blocks: DataFrame) -> DataFrame:
    """Each different item with its terms, their number in it and their document frequency."""
    pairs = items.select(F.col(item).alias("item"), F.coalesce(text, F.lit("")).alias("text")).distinct()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts = [term_counts(t.as_buffer().to_pybytes()) for t in part.column("text")]
                of = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("item").take(pa.array(of)),
                        part.column("query").take(pa.array(of)),
                        pa.array([t.decode() for c in counts for t in c], pa.string()),
                        pa.array([v for c in counts for v in c.values()], pa.int64()),
                    ],
                    names=["item", "query", "term", "times"],
                )

    kind = items.schema[item].dataType.simpleString()
    pairs = pairs.withColumn("query", F.xxhash64("item", "text"))
    terms = stored(pairs.mapInArrow(counted, f"item {kind}, query bigint, term string, times bigint"), "item-terms")
    wanted = terms.select("term").distinct()
    dictionary = blocks.where("terms is not null").select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.df").alias("df"))
    df = dictionary.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    of = F.collect_list(F.struct("term", "times", "df")).alias("terms")
    return stored(terms.join(df, "term").groupBy("item", "query").agg(of), "items")


def _passes(prepared: DataFrame, documents: int, total: int) -> Iterator[tuple[Items, list]]:
    """Items by bounded numbers, and their ids."""

    def weights(terms) -> dict[bytes, int]:
        every = {t["term"].encode(): t["times"] * math.floor(1000 * math.log((2 * documents + 2) / (2 * t["df"] + 1))) for t in terms}
        return {t: w for t, w in every.items() if w}

    ids, gathered, terms = [], [], set()
    for r in prepared.orderBy("item", "query").toLocalIterator():
        own = weights(r["terms"])
        if ids and (len(ids) == ITEMS or len(terms | own.keys()) > TERMS):
            yield Items(list(range(len(ids))), gathered, documents, total), ids
            ids, gathered, terms = [], [], set()
        ids.append(r["item"])
        gathered.append(own)
        terms |= own.keys()
    if ids:
        yield Items(list(range(len(ids))), gathered, documents, total), ids


def _bounded(blocks: DataFrame, shared, keep) -> DataFrame:
    """item and row of the documents that keep(bounds) selects, as keep gives them, task by task."""

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, keeper = Bounds(shared.value), keep()
        for batch in batches:
            for i in range(batch.num_rows):
                col = lambda name, i=i: batch.column(name)[i]
                row, n, most = (col(c).values.to_numpy() for c in ("row", "n", "most"))
                found = bounds.of(col("width").as_py(), n, most, col("slices").as_buffer())
                yield from map(_found, keeper.block(row, found))
        yield from map(_found, keeper.end())

    return blocks.select("width", "row", "n", "most", "slices").mapInArrow(bounded, "item int, row bigint, bound double")


def _found(columns: tuple) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["item", "row", "bound"])


class _Highest:
    """The rows of the highest bounds of each item that a task sees."""

    def __init__(self, count: int):
        self.count, self.row, self.bound = count, None, None

    def block(self, row: np.ndarray, bound: np.ndarray) -> list:
        row = np.broadcast_to(row, bound.shape)
        if self.bound is not None:
            row, bound = np.hstack((self.row, row)), np.hstack((self.bound, bound))
        if bound.shape[1] > self.count:
            at = np.argpartition(-bound, self.count - 1, axis=1)[:, : self.count]
            row, bound = np.take_along_axis(row, at, 1), np.take_along_axis(bound, at, 1)
        self.row, self.bound = row, bound
        return []

    def end(self) -> list:
        if self.bound is None:
            return []
        item, at = np.nonzero(self.bound > 0)
        return [(item, self.row[item, at], self.bound[item, at])]


class _Reaching:
    """All rows whose bound reaches the item's least score."""

    def __init__(self, least: np.ndarray):
        self.least = np.maximum(least, 1)[:, None]

    def block(self, row: np.ndarray, bound: np.ndarray) -> list:
        item, at = np.nonzero(bound >= self.least)
        return [(item, row[at], bound[item, at])] if len(item) else []

    def end(self) -> list:
        return []


def _scored(rows: DataFrame, found: DataFrame, shared, key_kind: str) -> DataFrame:
    """item, key and exact score above 0 of the (item, row) pairs of found."""
    asked = stored(found.groupBy("row").agg(F.collect_set("item").alias("items")), "asked")
    pairs = asked.agg(F.sum(F.size("items")).alias("n")).first()["n"] or 0
    joined = rows.join(F.broadcast(asked) if pairs <= SENT else asked, "row").select("key", "text", "items")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                of, item, score = [], [], []
                for i, (t, wanted) in enumerate(zip(part.column("text"), part.column("items").to_pylist(), strict=True)):
                    counts = term_counts(t.as_buffer().to_pybytes()) if t.is_valid else Counter()
                    m = items.length(counts.total())
                    for one in wanted:
                        if value := items.score(one, counts, m):
                            of.append(i)
                            item.append(one)
                            score.append(value)
                found = [pa.array(item, pa.int32()), part.column("key").take(pa.array(of, pa.int64())), pa.array(score, pa.int64())]
                yield pa.RecordBatch.from_arrays(found, names=["item", "key", "score"])

    return joined.mapInArrow(scored, f"item int, key {key_kind}, score bigint")


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("key").asc_nulls_last()]
    return scores.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", item: str = "item_id", text: str = "text", blocks: DataFrame | None = None) -> DataFrame:
    """Each item's k highest-scoring documents: item, rank, key and score. blocks: the index, if there is one."""
    spark = docs.sparkSession
    blocks = index(docs, key, text) if blocks is None else blocks
    sums = blocks.agg(F.sum(F.size("row")).alias("documents"), F.sum(F.aggregate("n", F.lit(0).cast("bigint"), lambda a, n: a + n)).alias("total")).first()
    rows, kind = _rows(docs, key, text), docs.schema[key].dataType.simpleString()
    item_kind = items.schema[item].dataType
    shape = T.StructType([T.StructField("item", T.IntegerType()), T.StructField(item, item_kind)])
    out = spark.createDataFrame([], T.StructType([T.StructField(item, item_kind)])).withColumns(
        {"rank": F.lit(0), key: F.lit(None).cast(kind), "score": F.lit(0).cast("bigint")}
    )
    if not sums["documents"]:
        return out
    for some, ids in _passes(_prepared(items, item, text, blocks), sums["documents"], sums["total"]):
        shared = spark.sparkContext.broadcast(some)
        pilots = PILOTS * k
        first = _bounded(blocks, shared, lambda n=pilots: _Highest(n))
        best = Window.partitionBy("item").orderBy(F.desc("bound"), "row")
        first = first.withColumn("_at", F.row_number().over(best)).where(F.col("_at") <= pilots)
        tried = _ranked(_scored(rows, first, shared, kind), k).where(F.col("rank") == k).select("item", "score").collect()
        least = np.zeros(len(ids))
        for r in tried:
            least[r["item"]] = r["score"]
        reaching = _bounded(blocks, shared, lambda low=least: _Reaching(low))
        ranked = stored(_ranked(_scored(rows, reaching, shared, kind), k), "ranked")
        shared.destroy()
        names = spark.createDataFrame(list(enumerate(ids)), shape)
        out = out.unionByName(ranked.join(F.broadcast(names), "item").select(item, "rank", F.col("key").alias(key), "score"))
    return out
