"""Substring dedup: paragraphs by MinHash banding, verified by exact Jaccard, clustered, and cut.

Paragraphs are cut where the text itself says so: before a word whose pair hash is the smallest of
its REACH neighbours on either side. So a passage that stands in two documents is cut alike in both,
wherever in a line it stands; paragraphs are some 7 words long, so every passage of `least` words
holds a whole one. Words are compared without case and punctuation.

1. Every paragraph gets BANDS band keys, each the smallest of its hashed word shingles under one of
   as many functions (bands of one row: two paragraphs of similarity s share a key with probability
   1 - (1 - s)^BANDS, and a passage has several paragraphs). Paragraphs of so few shingles that only
   equal ones are similar need one key. Keys that occur in one document only leave here, after an
   aggregation with map-side combining.
2. Documents with shared keys are read again for the words of these paragraphs. Different paragraphs
   with a common key are linked if the Jaccard similarity of their shingles is at least `similarity`.
   Keys with many different paragraphs are dealt out in blocks whose tasks return a spanning set of
   the links, so no pairs of a large group are emitted.
3. Components of the links are clusters of paragraphs. Of each, the document with the smallest key
   keeps its paragraphs. In the others paragraphs are seeds: those that follow each other in the same
   kept document are a stretch, whose words are aligned with the kept ones to both sides, over gaps
   of up to CONTEXT words. Of runs that agree, the longest chain with at least `least` words and an
   exact Jaccard of its shingles of `similarity` with the kept chain is removed, the words between its
   runs included. Runs that agree word for word and touch are removed too if they have `least` words
   together, also if different documents keep them.

Equal rows (same key and text) are one document, they are treated alike and do not remove each
other's text. Null texts are empty and stay null. Empty tables give no rows. Extra columns stay;
columns named spans, removed_words, clusters or kept_in are replaced.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from .common import let, slices, spent, stored, text_bytes
from .components import components
from .toxicity import _CODES, _mixed, _powers

SHINGLE = 5
SIMILARITY = 0.8
#: Words of a passage that is removed.
LEAST = 50
REACH = 3
BANDS = 2
#: Words beside a stretch that its ends may grow by, and between two runs of a passage.
CONTEXT = 64
#: Paragraphs from one seed to the next in a stretch.
NEAR = 8
#: Shorter runs may agree by chance; they join no others that a different document keeps.
RUN = 12
#: Different paragraphs of a key that the join still turns into pairs, and members of a block beyond.
JOINED = 16
BLOCK = 512
#: Runs of a chain that are compared with all later ones at once.
SIDE = 32
#: Bytes of texts whose words are numbered together.
TOGETHER = 1 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_MARKS = bytes(b for b in range(128) if b != 32 and not chr(b).isalnum())


def row_key(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key), F.col(text))


class Cut:
    """Words of a batch of texts, and the paragraphs they fall into."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        inside = ~_BLANK[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        heads = ends[:-1][ends[:-1] < len(data)]
        first[heads] = inside[heads]
        self.starts = np.flatnonzero(first)
        self.stops = np.flatnonzero(inside & np.append(~inside[1:] | first[1:], True)) + 1 if len(data) else self.starts
        n = len(self.starts)
        self.text = np.searchsorted(ends, self.starts, side="right") - 1
        if not n:
            self.words = np.empty(0, np.uint64)
            self.opens = np.empty(0, np.int64)
            return
        code = _CODES[data]
        up, down = _powers(len(data))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(code * up[:-1], dtype=np.uint64)))
        self.words = _mixed((sums[self.stops] - sums[self.starts]) * down[self.starts] + np.uint64(1))
        same = self.text[1:] == self.text[:-1]
        pair = np.full(n, np.uint64(2**64 - 1))
        pair[:-1][same] = _mixed(self.words[:-1] * np.uint64(3) + self.words[1:] * np.uint64(5))[same]
        low = pair != np.uint64(2**64 - 1)
        for d in range(1, min(REACH, n - 1) + 1):
            near = self.text[d:] == self.text[:-d]
            low[d:] &= ~near | (pair[d:] < pair[:-d])
            low[:-d] &= ~near | (pair[:-d] <= pair[d:])
        # A text's first word opens a paragraph; words near an edge have no full neighbourhood.
        low[0] = True
        low[1:] |= ~same
        self.opens = np.flatnonzero(low)

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text and number in it of each paragraph, and its band keys by row."""
        n, opens = len(self.words), self.opens
        ends = np.append(opens[1:], n)
        of = self.text[opens]
        number = np.arange(len(opens)) - np.searchsorted(of, of)
        size = ends - opens
        shingle = np.zeros(n, np.uint64)
        for k in range(min(SHINGLE, n)):
            shingle[: n - k] += self.words[k:] * np.uint64(2 * k + 3)
        left = np.repeat(ends, size) - np.arange(n)
        whole = left >= SHINGLE
        short = np.flatnonzero(size < SHINGLE)
        if len(short):
            # Fewer words than a shingle has: the whole sequence.
            place = np.arange(n) - np.repeat(opens, size)
            weighted = np.add.reduceat(self.words * (2 * place + 3).astype(np.uint64), opens)
            shingle[opens[short]] = weighted[short]
            whole[opens[short]] = True
        out = np.empty((BANDS, len(opens)), np.uint64)
        for b in range(BANDS):
            value = _mixed(shingle + np.uint64((b + 1) * 0x9E3779B97F4A7C15 % 2**64))
            value[~whole] = np.uint64(2**64 - 1)
            out[b] = np.minimum.reduceat(value, opens)
        return of, number, out


def _plain_text(piece: bytes) -> bytes:
    """Words of a piece of text without case and punctuation, between blanks; a word of punctuation only is a dash."""
    plain = b" ".join(piece.split()).translate(_LOWER, _MARKS)
    if b"  " in plain or plain[:1] in b" " or plain[-1:] == b" ":
        return b" ".join([w or b"-" for w in plain.split(b" ")])
    return plain


def _plain(piece: bytes) -> list[bytes]:
    return _plain_text(piece).split(b" ")


def _emitted(docs: DataFrame, text: str, similarity: float) -> DataFrame:
    """Band keys of every paragraph: key, row, number. docs has columns row and text."""
    # Sets that differ have a Jaccard of at most (n - 1) / n, n the larger size.
    equal = next(n for n in range(1, 1000) if n / (n + 1) >= similarity) if similarity < 0.999 else 999

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, 1 << 20):
                cut = Cut(*text_bytes(part.column(text)))
                if not len(cut.opens):
                    continue
                of, number, keys = cut.keys()
                rows = part.column("row").to_numpy()[of]
                several = np.diff(np.append(cut.opens, len(cut.words))) - SHINGLE + 1 >= equal
                for band, k in enumerate(keys):
                    at = several if band else slice(None)
                    yield pa.RecordBatch.from_arrays([pa.array(k[at].view(np.int64)), pa.array(rows[at]), pa.array(number[at].astype(np.int32))], names=["key", "row", "number"])

    return docs.select("row", text).mapInArrow(emitted, "key bigint, row bigint, number int")


def _read(suspects: DataFrame, asked: str, text: str, schema: str, answers) -> DataFrame:
    """Columns that answers(plain, opens, requests) gives for the requests of a document, after its row.

    suspects has columns row, text and the list `asked`; plain are the document's plain words, opens
    the numbers of the words that open its paragraphs, and the number of its words.
    """
    names = [c.split(" ")[0] for c in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    types = [kinds[c.split(" ")[1]] for c in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, 1 << 20):
                data, ends = text_bytes(part.column(text))
                cut = Cut(data, ends)
                opens_of = np.searchsorted(cut.text[cut.opens], np.arange(part.num_rows + 1))
                bounds = np.append(cut.opens, len(cut.words))
                whole = data.tobytes()
                many, cols = [], [[] for _ in types[1:]]
                for i, requests in enumerate(part.column(asked).to_pylist()):
                    own = bounds[opens_of[i] : opens_of[i + 1] + 1]
                    found = answers(_plain(whole[ends[i] : ends[i + 1]]), (own - own[0]).tolist(), requests)
                    many.append(len(requests))
                    for col, more in zip(cols, found, strict=True):
                        col += more
                rows = np.repeat(part.column("row").to_numpy(), many)
                made = [pa.array(c, pa.binary()).cast(t) if t == pa.string() else pa.array(c, t) for c, t in zip(cols, types[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, types[0]), *made], names=names)

    return suspects.select("row", text, asked).mapInArrow(read, schema)


def _words_of(plain: list[bytes], opens: list[int], numbers: list[int]) -> tuple[list, ...]:
    return numbers, [b" ".join(plain[opens[n] : opens[n + 1]]) for n in numbers]


def _around(plain: list[bytes], opens: list[int], requests: list[dict]) -> tuple[list, ...]:
    """Words of stretches of paragraphs with CONTEXT words on either side, and where their paragraphs open in them."""
    firsts, lasts = [r["k_first"] for r in requests], [r["k_last"] for r in requests]
    lows = [max(opens[first] - CONTEXT, 0) for first in firsts]
    offsets = [" ".join([str(o - low) for o in opens[first : last + 1]]).encode() for first, last, low in zip(firsts, lasts, lows, strict=True)]
    words = [b" ".join(plain[low : opens[last + 1] + CONTEXT]) for last, low in zip(lasts, lows, strict=True)]
    return firsts, lasts, offsets, words


def shingles(words: Column) -> Column:
    """Distinct shingles of words in one string, as 64-bit hashes."""

    def of(split: Column) -> Column:
        n = F.size(split)
        runs = F.transform(F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*[F.get(split, i + k) for k in range(SHINGLE)]))
        return F.when(n < SHINGLE, F.array(F.xxhash64(words))).otherwise(F.array_distinct(runs))

    return let(F.split(words, " "), of)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays without repeats."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def _links(contents: DataFrame, similarity: float) -> DataFrame:
    """Links between different paragraphs. contents: id, keys, words; one row per paragraph text."""
    wide = contents.select("id", "words", F.explode(F.array_distinct("keys")).alias("key"))
    load = wide.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    load = stored(load, "band-loads")
    # Shingles are made once, of the paragraphs that share a key with a different one.
    near = wide.join(load.where(F.col("n") <= JOINED), "key").withColumn("s", shingles(F.col("words")))
    near = stored(near.select("key", "id", "s", F.size("s").alias("size")), "shingles")
    one, two = (near.select("key", *[F.col(c).alias(c + n) for c in ("id", "s", "size")]) for n in "ab")
    fits = F.least("sizea", "sizeb") >= similarity * F.greatest("sizea", "sizeb")
    pairs = one.join(two, "key").where((F.col("ida") < F.col("idb")) & fits & (jaccard(F.col("sa"), F.col("sb")) >= similarity))
    linked = pairs.select(F.col("ida").alias("a"), F.col("idb").alias("b"))
    large = load.where(F.col("n") > JOINED).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).drop("n")
    at = ["key", "x", "y"]
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = wide.join(large, "key")
    one = rows.withColumn("x", own).withColumn("y", each).where("x <= y").select(*at, "id", "words")
    two = rows.withColumn("y", own).withColumn("x", each).where("x <= y")
    two = two.select(*[F.col(c).alias(c) for c in (*at, "id", "words")])  # its own columns beside those of `one`

    def span(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return spanning(left, right, similarity)

    spanned = one.groupBy(at).cogroup(two.groupBy(at)).applyInPandas(span, "a bigint, b bigint")
    links = stored(linked.unionByName(spanned), "links")
    spent(load, near)
    return links


def _shingle_set(words: str) -> frozenset:
    w = words.split(" ")
    return frozenset(" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)) if len(w) >= SHINGLE else frozenset([words])


def spanning(left: pd.DataFrame, right: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links between two blocks of paragraphs that connect what all their similar pairs connect.

    Pairs that are connected already, or whose sizes rule the similarity out, are not compared.
    """
    sets = {i: _shingle_set(w) for f in (left, right) for i, w in zip(f["id"].tolist(), f["words"], strict=True)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    order = sorted(set(right["id"].tolist()), key=lambda i: len(sets[i]))
    out = []
    for a in sorted(set(left["id"].tolist())):
        sa = sets[a]
        for b in order:
            sb = sets[b]
            if len(sb) < similarity * len(sa):
                continue
            if len(sb) * similarity > len(sa):
                break
            if a != b and find(a) != find(b):
                both = len(sa & sb)
                if both >= similarity * (len(sa) + len(sb) - both):
                    root[max(find(a), find(b))] = min(find(a), find(b))
                    out.append((a, b))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _runs_of_words(texts: list[bytes]) -> list[list[int]]:
    """The shingles of several texts of words between blanks as numbers: equal ones for equal shingles only."""
    split = pc.split_pattern(pa.array(texts, pa.large_binary()), " ")
    ends, words = split.offsets.to_numpy().tolist(), split.flatten().dictionary_encode()
    number = words.indices.to_numpy().astype(np.int64)
    bits = used = max(1, (len(words.dictionary) - 1).bit_length())
    code = number
    for k in range(1, SHINGLE):
        if used + bits > 62:
            # Too many for one number: the ones that occur are numbered anew.
            code = pd.factorize(code)[0]
            used = len(code).bit_length()
        code = (code[:-1] << bits) | number[k:]
        used += bits
    return [code[a : max(a, b - SHINGLE + 1)].tolist() for a, b in itertools.pairwise(ends)]


def _runs(of: list[int], kept: list[int], i: int, j: int) -> list[tuple[int, int, int]]:
    """Runs of equal shingles from of[i] and kept[j] on, over gaps: start in both, and shingles."""
    out = []
    while True:
        n, most = 0, min(len(of) - i, len(kept) - j)
        while n < most and of[i + n] == kept[j + n]:
            n += 1
        if n:
            out.append((i, j, n))
        i, j = i + n, j + n
        # The next shingle that both have, nearest in both together.
        window = kept[j : j + CONTEXT + SHINGLE]
        at = dict(zip(reversed(window), range(len(window) - 1, -1, -1), strict=True))
        best = None
        for x, shingle in enumerate(of[i : i + CONTEXT + SHINGLE]):
            if best and x >= best[0] + best[1]:
                break
            y = at.get(shingle)
            if y is not None and (best is None or x + y < best[0] + best[1]):
                best = x, y
        if best is None:
            return out
        i, j = i + best[0], j + best[1]


def _aligned(of: list[int], kept: list[int], seeds: list[tuple[int, int]]) -> list[list[tuple[int, int, int]]]:
    """Chains of runs through the seeds (places in both), each to both sides as far as it goes."""
    back, kept_back, chains, done = of[::-1], kept[::-1], [], -1
    for i, j in seeds:
        if i < done or i >= len(of) or j >= len(kept):
            continue
        left = [(len(of) - x - n, len(kept) - y - n, n) for x, y, n in _runs(back, kept_back, len(of) - i, len(kept) - j)][::-1]
        right = _runs(of, kept, i, j)
        if left and right and left[-1][0] + left[-1][2] == right[0][0] and left[-1][1] + left[-1][2] == right[0][1]:
            right[0] = left[-1][0], left[-1][1], left[-1][2] + right[0][2]
            left.pop()
        if left + right:
            chains.append(left + right)
            done = max(done, chains[-1][-1][0] + chains[-1][-1][2])
    return chains


def similar(of: list[int], kept: list[int], chain: list[tuple[int, int, int]], similarity: float, least: int) -> list[tuple[int, int]]:
    """Words from and to of the longest parts of a chain that have the exact Jaccard and `least` words."""
    if chain[-1][0] + chain[-1][2] - chain[0][0] + SHINGLE - 1 < least:
        return []
    if len(chain) == 1:  # the same words in both
        return [(chain[0][0], chain[0][0] + chain[0][2] + SHINGLE - 1)]
    x, y, n = np.array(chain).T
    sums = np.concatenate(([0], np.cumsum(n)))
    gap = np.maximum(x[1:] - x[:-1] - n[:-1], y[1:] - y[:-1] - n[:-1])
    # A run at an end is as long as the gap before it, in words beyond a shingle's.
    opens = np.append(n[:-1] >= gap - 2 * (SHINGLE - 1), True)
    closes = np.append(True, n[1:] >= gap - 2 * (SHINGLE - 1))
    found, todo = [], [(0, len(chain))]
    while todo:
        a, b = todo.pop()
        if a == b:
            continue
        # The whole is longer than any part of it.
        i, j = a, b - 1
        if opens[i] & closes[j] or i == j:
            both, size, other = sums[b] - sums[a], x[j] + n[j] - x[i], y[j] + n[j] - y[i]
            if both * (1 + similarity) >= similarity * (size + other) - 1e-9 and size + SHINGLE - 1 >= least:
                one, two = set(of[x[i] : x[j] + n[j]]), set(kept[y[i] : y[j] + n[j]])
                if len(one & two) >= similarity * len(one | two):
                    found.append((int(x[i]), int(x[j] + n[j]) + SHINGLE - 1))
                    continue
        if b - a == 1:
            continue
        tries = []
        for first in range(a, b, SIDE):
            i = np.arange(first, min(first + SIDE, b))[:, None]
            size = x[first:b] + n[first:b] - x[i]
            fits = (sums[first + 1 : b + 1] - sums[i]) * (1 + similarity) >= similarity * (size + y[first:b] + n[first:b] - y[i]) - 1e-9
            own = np.arange(first, b) == i
            fits &= (size + SHINGLE - 1 >= least) & ((opens[i] & closes[first:b]) | own) & (np.arange(first, b) >= i)
            some = np.flatnonzero(fits.any(axis=1))
            # The longest of each first run.
            last = fits.shape[1] - 1 - fits[some, ::-1].argmax(axis=1)
            tries += [(int(size[k, m]), first + int(k), first + int(m)) for k, m in zip(some, last, strict=True)]
        for _, i, j in sorted(tries, key=lambda t: -t[0]):
            one, two = set(of[x[i] : x[j] + n[j]]), set(kept[y[i] : y[j] + n[j]])
            if len(one & two) >= similarity * len(one | two):
                found.append((int(x[i]), int(x[j] + n[j]) + SHINGLE - 1))
                todo += [(a, i), (j + 1, b)]
                break
    return found


def _joined(spans: list[tuple]) -> list[tuple]:
    """Spans (from, to, who) that touch or overlap as one, with who of all that add to it."""
    out = []
    for a, b, who in sorted(spans, key=lambda t: (t[0], -t[1])):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = out[-1][0], b, out[-1][2] | who
        else:
            out.append((a, b, who))
    return out


def _to_cut(of: list[int], others: list[list[int]], bounds: list[int], stretches: list[tuple], similarity: float, least: int) -> list[tuple]:
    """Words from and to that a document loses, and the numbers of the stretches they are in. bounds: where its paragraphs open.

    of, others: shingles of the document and of the kept stretches. stretches: offsets of the kept stretch, its first
    paragraph, and the paragraphs of its seeds here and there.
    """
    known, near, runs = set(of), [], []
    for who, ((offsets, k_first, numbers, k_numbers), kept) in enumerate(zip(stretches, others, strict=True)):
        if sum(map(known.__contains__, kept)) < RUN - SHINGLE + 1:
            continue
        opens = [int(o) for o in offsets.split(b" ")]
        seeds = sorted((bounds[n], opens[k - k_first]) for n, k in zip(numbers, k_numbers, strict=True))
        for chain in _aligned(of, kept, seeds):
            near += [(a, b, {who}) for a, b in similar(of, kept, chain, similarity, least)]
            runs += [(a, a + n + SHINGLE - 1, {who}) for a, _, n in chain if n + SHINGLE - 1 >= RUN]
    return _joined(near + [r for r in _joined(runs) if r[1] - r[0] >= least])


def _passages(flagged: DataFrame, text: str, similarity: float, least: int, kind_of_key: str) -> DataFrame:
    """Spans (start, end in characters) to remove of each document, the clusters of their paragraphs,
    and the keys of the documents that keep them. flagged: row, text, stretches."""

    key_lists = pa.list_(to_arrow_type(T._parse_datatype_string(kind_of_key)))

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, 1 << 20):
                data, ends = text_bytes(part.column(text))
                cut = Cut(data, ends)
                opens_of = np.searchsorted(cut.text[cut.opens], np.arange(part.num_rows + 1))
                bounds = np.append(cut.opens, len(cut.words))
                whole = data.tobytes()
                rows, spans, words, clusters, keepers = [], [], [], [], []
                # Lists of structs column by column: as Python objects most of them would be made for nothing.
                lists = part.column("stretches")
                first = lists.offsets.to_numpy()
                flat = lists.values.slice(first[0], first[-1] - first[0])
                first = first - first[0]
                seeds = flat.field("seeds")
                seed_at = seeds.offsets.to_numpy()
                number, k_number, cluster = (seeds.values.field(c).to_numpy() for c in ("number", "k_number", "cluster"))
                kept_words, offsets = (flat.field(c).cast(pa.binary()).to_pylist() for c in ("words", "offsets"))
                k_first, keeper = flat.field("k_first").to_pylist(), flat.field("keeper")
                texts = [_plain_text(whole[ends[i] : ends[i + 1]]) for i in range(part.num_rows)]
                load = np.cumsum([0, *(len(t) + sum(map(len, kept_words[first[i] : first[i + 1]])) for i, t in enumerate(texts))])
                shingled, upto = iter(()), 0
                for i in range(part.num_rows):
                    if i == upto:
                        upto = max(i + 1, int(np.searchsorted(load, load[i] + TOGETHER, side="right")) - 1)
                        shingled = iter(_runs_of_words([t for d in range(i, upto) for t in (texts[d], *kept_words[first[d] : first[d + 1]])]))
                    several = range(first[i], first[i + 1])
                    of_seeds = [slice(seed_at[s], seed_at[s + 1]) for s in several]
                    stretches = [(offsets[s], k_first[s], number[at].tolist(), k_number[at].tolist()) for s, at in zip(several, of_seeds, strict=True)]
                    a = int(bounds[opens_of[i]])
                    base = int(ends[i])
                    head = whole[base : int(ends[i + 1])]
                    own = (bounds[opens_of[i] : opens_of[i + 1] + 1] - a).tolist()
                    of, *others = itertools.islice(shingled, 1 + len(several))
                    found = _to_cut(of, others, own, stretches, similarity, least)
                    if found:
                        found = [(a + x, a + y, who) for x, y, who in found]
                        used = {w for _, _, who in found for w in who}
                        of = {c for w in used for c in cluster[of_seeds[w]].tolist()}
                        keep = {keeper[several[w]].as_py() for w in used}
                        rows.append(part.column("row")[i].as_py())
                        spans.append([{"start": len(head[: cut.starts[x] - base].decode()), "end": len(head[: cut.stops[y - 1] - base].decode())} for x, y, _ in found])
                        words.append(sum(y - x for x, y, _ in found))
                        clusters.append(sorted(of))
                        keepers.append(sorted(keep - {None}))
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array(spans, kind), pa.array(words, pa.int64()), pa.array(clusters, pa.list_(pa.int64())), pa.array(keepers, key_lists)],
                    names=["row", "spans", "removed_words", "clusters", "kept_in"],
                )

    return flagged.select("row", text, "stretches").mapInArrow(passages, f"row bigint, spans array<struct<start:int,end:int>>, removed_words bigint, clusters array<bigint>, kept_in array<{kind_of_key}>")


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, least: int = LEAST) -> DataFrame:
    """row (hash of key and text), spans, removed_words, clusters and kept_in (keys) of the documents with passages to remove."""
    rows = docs.select(F.col(key), F.coalesce(text, F.lit("")).alias(text)).withColumn("row", row_key(key, text)).where(F.length(text) > 0)
    # Every table goes once the one made from it is written.
    keys = stored(_emitted(rows, text, similarity), "bands")
    shared = keys.groupBy("key").agg(F.min("row").alias("a"), F.max("row").alias("b")).where("a != b").select("key")
    # The shared keys of a partition are few beside its rows, which then need no sort.
    hits = stored(keys.join(shared.hint("shuffle_hash"), "key"), "shared-bands")
    spent(keys)
    numbers = hits.groupBy("row").agg(F.collect_set("number").alias("numbers"))
    # Equal rows are one document.
    suspects = stored(rows.join(numbers, "row").dropDuplicates(["row"]), "suspects")
    members = stored(_read(suspects, "numbers", text, "row bigint, number int, words string", _words_of), "paragraphs")
    own_id = F.xxhash64("words").alias("id")
    of_key = members.select("row", "number", own_id).join(hits, ["row", "number"])
    contents = members.groupBy(own_id).agg(F.first("words").alias("words")).join(of_key.groupBy("id").agg(F.collect_set("key").alias("keys")), "id")
    contents = stored(contents, "contents")
    spent(hits)
    links = _links(contents, similarity)
    spent(contents)
    found = components(links)
    spent(links)
    of_cluster = found.withColumnsRenamed({"node": "id", "root": "_root"})
    # Of a paragraph only its cluster and its document's key are needed from here on.
    placed = members.select("row", "number", own_id).join(of_cluster, "id", "left").withColumn("cluster", F.coalesce("_root", "id")).drop("_root", "id")
    placed = stored(placed.join(suspects.select("row", key), "row"), "placed")
    spent(members, found)
    own = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("keeper"), F.col("row").alias("k_row"), F.col("number").alias("k_number"))
    first = placed.groupBy("cluster").agg(F.min(own).alias("kept")).select("cluster", "kept.keeper", "kept.k_row", "kept.k_number")
    others = placed.select("row", "number", "cluster").join(first, "cluster").where(F.col("row") != F.col("k_row"))
    # Seeds that follow each other in both documents are a stretch.
    along = Window.partitionBy("row", "k_row").orderBy("number")
    step, k_step = (F.col(c) - F.lag(c).over(along) for c in ("number", "k_number"))
    others = others.withColumn("opens", F.coalesce((step > NEAR) | (k_step <= 0) | (k_step > NEAR), F.lit(True)).cast("int"))
    seeds = F.sort_array(F.collect_list(F.struct("number", "k_number", "cluster")))
    edges = (
        others.withColumn("stretch", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "k_row", "stretch")
        .agg(F.min("k_number").alias("k_first"), F.max("k_number").alias("k_last"), F.first("keeper").alias("keeper"), seeds.alias("seeds"))
    )
    edges = stored(edges.drop("stretch"), "edges")
    spent(placed)
    # The kept words of a stretch, asked once for all that have it.
    wanted = edges.select("k_row", "k_first", "k_last").distinct().groupBy(F.col("k_row").alias("row")).agg(F.collect_list(F.struct("k_first", "k_last")).alias("asked"))
    beside = _read(suspects.join(wanted, "row"), "asked", text, "row bigint, k_first int, k_last int, offsets string, words string", _around)
    beside = stored(beside.withColumnRenamed("row", "k_row"), "beside")
    stretch = F.struct(F.col("keeper").isNull().alias("none"), "keeper", "k_first", "seeds", "offsets", "words")
    flagged = edges.join(beside, ["k_row", "k_first", "k_last"]).groupBy("row").agg(F.sort_array(F.collect_list(stretch)).alias("stretches"))
    kind = docs.schema[key].dataType.simpleString()
    passages = stored(_passages(suspects.join(flagged, "row"), text, similarity, least, kind), "passages")
    spent(suspects, edges, beside)
    return passages


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, least: int = LEAST) -> DataFrame:
    """docs without the passages, with spans (where they were), removed_words, clusters and kept_in."""
    found = repeats(docs, key, text, similarity, least).withColumnRenamed("row", "_passage_row")
    plain = docs.drop("spans", "removed_words", "clusters", "kept_in")
    joined = plain.withColumn("_passage_row", row_key(key, text)).join(found, "_passage_row", "left").drop("_passage_row")
    kept = without(F.col(text), F.col("spans"))
    return joined.withColumn(text, F.when(F.col("spans").isNull(), F.col(text)).otherwise(kept)).withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("bigint"))).select(
        *plain.columns, "spans", "removed_words", "clusters", "kept_in"
    )


def without(text: Column, spans: Column) -> Column:
    """The text between the spans."""
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text)))
    return F.array_join(F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda z: F.substring(text, z["a"] + 1, z["b"] - z["a"])), "")
