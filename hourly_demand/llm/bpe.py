"""Byte-level BPE encoding and decoding.

A text is split by the tokenizer's pattern; each match, a word, is encoded separately.

1. Words are counted over all texts. The most frequent ones (at most FREQUENT_WORDS of at most
   WORD_BYTES bytes each, so the table is bounded) are encoded with Spark's higher-order functions:
   a word starts as the array of the ranks of its bytes, and `aggregate` folds over as many steps as
   it has pairs. Each step takes the lowest rank of all neighbouring pairs, the leftmost first, puts
   the merged piece in place of the two and looks up only the two new pairs. Ranks come from a
   literal row of the plan: a two-choice hash table from (left, right) to the rank of the joined bytes.
2. The texts are read once more in Arrow batches. Frequent words are looked up; any other word goes
   through the same ranked merges where it stands (`Merger`), as the fold costs some 100 times more
   than a lookup and a join of all words would shuffle more than the input. No text and no token is
   shuffled, only the counts of distinct words.
3. Decoding joins the binary pieces of the ids.

A null text is an empty one. Empty texts have no ids. Repeated rows and extra columns stay.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import let, slices, text_bytes, with_columns

#: Distinct words that are folded once. With WORD_BYTES this bounds the table to some 20 MB.
FREQUENT_WORDS = 100_000
WORD_BYTES = 32
#: Tasks that share the fold.
FOLD_TASKS = 16
#: Words that a Python worker remembers besides.
REMEMBERED = 200_000
#: Words of more bytes are merged with a heap.
LONG_WORD = 100
#: Larger than any rank.
NO_RANK = 1 << 24
_RANK_BITS = 20
_RANKS = (1 << _RANK_BITS) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the bytes of a piece, a space and its rank, by line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Vocabulary:
    """Pieces by rank, and every pair of pieces whose joined bytes are a piece, in a hash table.

    A pair is left << 20 | right, so ranks have to be below 2^20. A slot holds pair << 20 | rank, an
    empty one -1. The slots of a pair are two cuts of its XXH64, and it lies in either.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if not ranks or max(ranks.values()) > _RANKS:
            raise ValueError("ranks have to be below 2^20, and there has to be one")
        self.ranks = ranks
        self.bytes = [ranks[bytes([b])] for b in range(256)]
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        pairs = {}
        for piece, rank in ranks.items():
            for k in range(1, len(piece)):
                left, right = ranks.get(piece[:k]), ranks.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left << _RANK_BITS | right] = rank
        self.bits, self.slots = _two_choice(pairs)

    def column(self, spark: SparkSession) -> Column:
        """The constants as one struct: slots, ranks of the 256 bytes.

        They are a local row of the plan, read as a scalar. As a literal inside the expression they
        would be printed, some 5 MB each time, wherever Spark describes the plan.
        """
        row = pa.table({"slots": pa.array([self.slots], pa.list_(pa.int64())), "bytes": pa.array([self.bytes], pa.list_(pa.int64()))})
        return spark.createDataFrame(row).select(F.struct("slots", "bytes").alias("t")).scalar()


def _choices(pair: int, bits: int) -> tuple[int, int]:
    """Spark's xxhash64 of a bigint, cut twice."""
    h = xxhash.xxh64_intdigest(struct.pack("<q", pair), 42)
    return h & ((1 << bits) - 1), h >> 32 & ((1 << bits) - 1)


def _two_choice(pairs: dict[int, int]) -> tuple[int, list[int]]:
    bits = max(4, (len(pairs) * 2).bit_length())
    while True:
        slots: dict[int, int] = {}
        choices = {p: _choices(p, bits) for p in pairs}
        if all(_placed(slots, choices, p) for p in pairs):
            return bits, [slots[i] << _RANK_BITS | pairs[slots[i]] if i in slots else -1 for i in range(1 << bits)]
        bits += 1


def _placed(slots: dict[int, int], choices: dict[int, tuple[int, int]], pair: int) -> bool:
    """Puts a pair into one of its two slots; what lay there moves to its other one."""
    at = choices[pair][0]
    for _ in range(500):
        if at not in slots:
            slots[at] = pair
            return True
        pair, slots[at] = slots[at], pair
        a, b = choices[pair]
        at = b if at == a else a
    return False


def _rank(slots: Column, bits: int, left: Column, right: Column) -> Column:
    """Rank of the piece that two neighbours make, NO_RANK if they make none."""
    mask, none = (1 << bits) - 1, F.lit(NO_RANK).cast("bigint")

    def look(pair: Column, cut: Column, otherwise: Column) -> Column:
        return let(
            F.get(slots, cut.bitwiseAND(F.lit(mask)).cast("int")),
            lambda x: F.when(F.shiftright(x, _RANK_BITS) == pair, x.bitwiseAND(F.lit(_RANKS))).otherwise(otherwise),
        )

    def found(pair: Column) -> Column:
        return let(F.xxhash64(pair), lambda h: look(pair, h, look(pair, F.shiftright(h, 32), none)))

    return let(F.shiftleft(left, _RANK_BITS).bitwiseOR(right), found)


def encode_word(word: Column, slots: Column, byte_ranks: Column, bits: int) -> Column:
    """Ids of one word as array<bigint>: the fold of ranked merges over its bytes."""
    none = F.array().cast("array<bigint>")
    rank = functools.partial(_rank, slots, bits)

    def merge(s: Column, m: Column, i: Column) -> Column:
        p, r = s["p"], s["r"]
        n = F.size(p)
        left = F.when(i > 1, F.array(rank(F.get(p, i - 2), m))).otherwise(none)
        right = F.when(i < n - 1, F.array(rank(m, F.get(p, i + 1)))).otherwise(none)
        return F.struct(
            F.flatten(F.array(F.slice(p, 1, i - 1), F.array(m), F.slice(p, i + 2, n))).alias("p"),
            F.flatten(F.array(F.slice(r, 1, F.greatest(i - 2, F.lit(0))), left, right, F.slice(r, i + 2, n))).alias("r"),
        )

    def step(s: Column, _: Column) -> Column:
        return let(
            F.array_min(s["r"]),
            lambda m: F.when(m.isNull() | (m >= NO_RANK), s).otherwise(
                let(F.array_position(s["r"], m).cast("int"), lambda i: merge(s, m, i))
            ),
        )

    def fold(b: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.size(b) - 1), lambda i: rank(F.get(b, i - 1), F.get(b, i)))
        start = F.struct(b.alias("p"), pairs.alias("r"))
        return F.when(F.size(b) < 2, b).otherwise(
            F.aggregate(F.sequence(F.lit(1), F.size(b) - 1), start, step, lambda s: s["p"])
        )

    def from_hex(h: Column) -> Column:
        each = F.sequence(F.lit(1), F.length(h) - 1, F.lit(2))
        return let(F.transform(each, lambda i: F.get(byte_ranks, F.conv(F.substring(h, i, F.lit(2)), 16, 10).cast("int"))), fold)

    return F.when(F.length(word) == 0, none).otherwise(let(F.hex(F.encode(word, "UTF-8")), from_hex))


def frequent_words(texts: DataFrame, column: str, pattern: str, limit: int = FREQUENT_WORDS) -> DataFrame:
    """The most frequent words of all texts, ties to the smaller word; column w."""
    words = texts.select(F.explode(F.regexp_extract_all(F.col(column), F.lit(f"(?U){pattern}"), F.lit(0))).alias("w"))
    counted = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    short = counted.where((F.octet_length("w") <= WORD_BYTES) & (F.col("n") > 1))
    # The sorted limit leaves one partition; the fold is worth spreading.
    return short.orderBy(F.desc("n"), "w").limit(limit).select("w").repartition(FOLD_TASKS, "w")


def encode_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """w and ids of each distinct word, by the fold."""
    ids = let(F.col("_t"), lambda t: encode_word(F.col("w"), t["slots"], t["bytes"], vocabulary.bits))
    return words.select("w", vocabulary.column(words.sparkSession).alias("_t")).select("w", ids.alias("ids"))


class Merger:
    """The ranked merges of one word in Python: lowest rank first, the leftmost of equal ones."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def ids(self, word: bytes) -> list[int]:
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        return self._by_heap(word) if len(word) > LONG_WORD else self._by_scan(word)

    def _by_scan(self, word: bytes) -> list[int]:
        get = self.ranks.get
        cuts = list(range(len(word) + 1))
        found = [get(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
        while found:
            low = min(found)
            if low == NO_RANK:
                break
            i = found.index(low)
            del cuts[i + 1], found[i]
            if i < len(found):
                found[i] = get(word[cuts[i] : cuts[i + 2]], NO_RANK)
            if i:
                found[i - 1] = get(word[cuts[i - 1] : cuts[i + 1]], NO_RANK)
        return [self.ranks[word[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _by_heap(self, word: bytes) -> list[int]:
        """The same in n log n steps: pieces as a linked list, pairs in a heap by rank and place."""
        get, n = self.ranks.get, len(word)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        gone = bytearray(n)
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if gone[i] or middle == n or end[middle] != stop:
                continue
            gone[middle] = 1
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := get(word[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (j := before[i]) >= 0 and (r := get(word[j:stop])) is not None:
                heapq.heappush(heap, (r, j, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i : end[i]]])
            i = end[i]
        return out


class Encoder:
    """Encodes texts on an executor: the table of frequent words, then the merges."""

    def __init__(self, ranks: dict[bytes, int], frequent: dict[str, bytes], pattern: str):
        self.find = regex.compile(pattern).findall
        self.known = dict(frequent)
        self.room = len(frequent) + REMEMBERED
        self.frequent, self.merger = frequent, Merger(ranks)

    def packed(self, text: str) -> bytes:
        """The ids as unsigned 32-bit integers, little end first."""
        words, known = self.find(text), self.known
        found = list(map(known.get, words))
        if None in found:
            for k, packed in enumerate(found):
                if packed is None:
                    found[k] = known.get(words[k]) or self._new(words[k])
        return b"".join(found)

    def _new(self, word: str) -> bytes:
        ids = self.merger.ids(word.encode())
        if len(self.known) >= self.room:
            self.known = dict(self.frequent)
        packed = np.array(ids, dtype="<u4").tobytes()
        self.known[word] = packed
        return packed


def packed_words(rows: pa.Table) -> tuple[bytes, np.ndarray, bytes, np.ndarray]:
    """Words and their ids (columns w and ids) as two runs of bytes with the ends of each, without a Python object a word."""
    if not rows.num_rows:
        return b"", np.empty(0, np.int64), b"", np.empty(0, np.int64)
    words, ids = (pa.concat_arrays(rows[c].chunks) for c in ("w", "ids"))
    data, ends = text_bytes(words)
    sizes = ids.value_lengths().to_numpy(zero_copy_only=False)
    return data.tobytes(), ends[1:], ids.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes(), 4 * np.cumsum(sizes)


def unpacked_words(words: bytes, word_ends: np.ndarray, ids: bytes, id_ends: np.ndarray) -> dict[str, bytes]:
    """The packed ids of each word."""
    out, a, b = {}, 0, 0
    for c, d in zip(word_ends.tolist(), id_ends.tolist(), strict=True):
        out[words[a:c].decode()] = ids[b:d]
        a, b = c, d
    return out


def decode(packed: bytes, pieces: np.ndarray) -> bytes:
    """The joined pieces of packed ids."""
    return b"".join(pieces[np.frombuffer(packed, dtype="<u4")])


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, column: str = "text", ids: bool = True) -> DataFrame:
    """docs with n_tokens, ids (array<int>, if asked for), ids_sha256 and decoded_sha256.

    ids_sha256 is the digest of the ids as little-endian unsigned 32-bit integers, decoded_sha256
    that of the bytes that decoding them gives. Of columns of docs with these names the new one stays.
    """
    vocabulary = Vocabulary(ranks)
    # Bounded: at most FREQUENT_WORDS rows of at most WORD_BYTES bytes and as many ids. They stay packed on the driver.
    rows = encode_words(frequent_words(docs, column, pattern), vocabulary).toArrow().combine_chunks()
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.pieces, packed_words(rows)))
    added = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    added |= {"ids": T.ArrayType(T.IntegerType())} if ids else {}

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_pieces, own_words = shared.value
        own_ranks = {p: rank for rank, p in enumerate(own_pieces) if p}
        encoder, pieces = Encoder(own_ranks, unpacked_words(*own_words), pattern), np.array(own_pieces, dtype=object)
        for batch in batches:
            for part in slices(batch, column):
                packed = [encoder.packed(t or "") for t in part.column(column).to_pylist()]
                new = {
                    "n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(decode(p, pieces)).hexdigest() for p in packed], pa.string()),
                }
                if ids:
                    new["ids"] = pa.array([np.frombuffer(p, dtype="<u4").astype("i4") for p in packed], pa.list_(pa.int32()))
                yield with_columns(part, new)

    kept = [f for f in docs.schema.fields if f.name not in added]
    schema = T.StructType(kept + [T.StructField(k, v) for k, v in added.items()])
    return docs.mapInArrow(encoded, schema)


def decode_ids(ids: Column, pieces: Column) -> Column:
    """Bytes of an array of ids as a column: pieces is an array of hex strings, one by rank."""
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))
