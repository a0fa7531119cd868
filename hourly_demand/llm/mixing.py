"""Mixing overlapping sources to target weights by a min-cost flow.

A document belongs to one or more sources. Documents are aggregated by the set of their sources,
their membership pattern; only these sums, one row per pattern, reach the driver. There a flow
routes words from each source's quota to the patterns that hold the source, and from a pattern
through one arc per repetition: as many words as the pattern has at the price 0 for the first use,
1 for the second, 4 for the third and so on. Prices are convex, so no text is repeated while another
one that would serve is unused. The cheapest flow that fills the quotas says how many words of each
pattern the mix takes.

Documents of a pattern are then selected in a seeded order: each is used as often as the flow uses
the whole pattern, and documents up to a cut of the order once more. The cut is found by histograms
of the order's leading bits that are refined around it, so no group of documents is ever sorted or
gathered. The document at the cut is longer than what is missing; it and others that are too long are
passed over, and the documents beyond the cut are cut again, until no unused one fits. That is one
walk through the order that takes whatever fits; each round leaves less than a document's size, so
rounds are as many as halvings of the sizes, in the mean.

Null texts have size 0, null sources are a source of their own, the last. Copies are separate
documents. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import stored

WORD = r"[^\x20\x09-\x0D]+"
#: The order within the cut's last bucket is a window over at most so many rows, if hashes differ.
BUCKET_ROWS = 20_000
#: Rounds after the first cut; None goes on until no unused document fits.
FILLS: int | None = None
#: A place in the order beyond all documents.
_END = 1 << 60
_STEP = 12


def words(text: Column) -> Column:
    """Number of words between ASCII blanks; null is 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def by_code_point(names: Sequence[str | None]) -> list[str | None]:
    return sorted((n for n in names if n is not None)) + ([None] if None in names else [])


def targets(sizes: dict, weight: Callable[[int], float], cap: int) -> dict:
    """Shares of the sum of all sizes by weight; a target stops at cap x its source's size, and the
    excess goes to the others by weight until none is above."""
    names = by_code_point(list(sizes))
    weights = {n: weight(i) for i, n in enumerate(names)}
    left, free, out = float(sum(sizes.values())), list(names), {}
    while free:
        unit = left / sum(weights[n] for n in free)
        full = [n for n in free if unit * weights[n] > cap * sizes[n]]
        if not full:
            return out | {n: unit * weights[n] for n in free}
        for n in full:
            out[n] = float(cap * sizes[n])
            left -= out[n]
        free = [n for n in free if n not in out]
    return out


def flow(quotas: dict, patterns: dict[str, tuple[list, int]], uses: int) -> dict[str, int]:
    """Words taken of each pattern by the cheapest flow that fills the quotas as far as can be.

    patterns: sources and words by name. Successive cheapest paths; every path fills an arc, so there
    are at most as many as arcs. The graph has a node per source and per pattern, not per document.
    """
    graph: dict = {}

    def arc(a, b, room: int, price: int) -> None:
        forth, back = [b, room, price, None], [a, 0, -price, None]
        forth[3], back[3] = back, forth
        graph.setdefault(a, []).append(forth)
        graph.setdefault(b, []).append(back)

    for source, quota in quotas.items():
        arc("from", ("source", source), quota, 0)
    for name, (sources, size) in patterns.items():
        for source in sources:
            arc(("source", source), ("pattern", name), uses * size, 0)
        for k in range(uses):
            arc(("pattern", name), "to", size, k * k)
    while True:
        price, came, todo = {"from": 0}, {}, ["from"]
        while todo:
            later = []
            for a in todo:
                for e in graph.get(a, ()):
                    if e[1] > 0 and price[a] + e[2] < price.get(e[0], 1 << 60):
                        price[e[0]] = price[a] + e[2]
                        came[e[0]] = e
                        later.append(e[0])
            todo = list(dict.fromkeys(later))
        if "to" not in price:
            break
        path, at = [], "to"
        while at != "from":
            path.append(came[at])
            at = came[at][3][0]
        room = min(e[1] for e in path)
        for e in path:
            e[1] -= room
            e[3][1] += room
    taken = {}
    for name in patterns:
        taken[name] = sum(e[3][1] for e in graph[("pattern", name)] if e[0] == "to")
    return taken


def _cuts(rows: DataFrame, rests: dict[str, int]) -> dict[str, tuple[int, int, int]]:
    """For each pattern the place in the order up to which the sizes stay within the rest: (first key,
    second key, words up to there), documents strictly below the place. A pattern whose documents all
    stay within has its place at the end, one without documents before the first."""
    spark = rows.sparkSession
    out = dict.fromkeys(rests, (-1, -1, 0))
    open_ = {p: (0, 0, r, 0) for p, r in rests.items() if r > 0}  # prefix of the bits so far, bits, rest, words before
    wide = rows.withColumn("_bits", F.array(*[F.shiftright(k, s).bitwiseAND(F.lit((1 << _STEP) - 1)) for k in ("_k1", "_k2") for s in (48, 36, 24, 12, 0)]))
    prefixes = {p: [] for p in open_}
    for level in range(10):
        if not open_:
            return out
        within = _within(spark, wide, prefixes, level)
        sums = (
            within.groupBy("_pattern", F.get("_bits", F.lit(level)).alias("b"))
            .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
            .withColumn("upto", F.sum("words").over(Window.partitionBy("_pattern").orderBy("b")))
        )
        rest = _small(spark, {p: v[2] for p, v in open_.items()}, "rest bigint")
        # The first bucket that goes beyond the rest; a pattern without one is wholly within.
        beyond = F.when(F.col("upto") > F.col("rest"), F.struct("b", "words", "n", "upto"))
        first = sums.join(F.broadcast(rest), "_pattern").groupBy("_pattern").agg(F.min(beyond).alias("x"), F.max("upto").alias("all"))
        found = first.collect()
        met = {r["_pattern"]: r["x"] for r in found if r["x"] is not None}
        if not level:
            out |= {r["_pattern"]: (_END, 0, r["all"]) for r in found if r["x"] is None}
            open_ = {p: v for p, v in open_.items() if p in met}
            prefixes = {p: [] for p in open_}
            if not open_:
                return out
        for p in list(open_):
            _, _, left, before = open_[p]
            if p not in met:
                raise ValueError(f"the cut of {p} is lost")
            x = met[p]
            prefixes[p] = [*prefixes[p], x["b"]]
            skipped = x["upto"] - x["words"]
            open_[p] = (0, level + 1, left - skipped, before + skipped)
        if max(met[p]["n"] for p in open_) <= BUCKET_ROWS:
            level += 1
            break
    else:
        level = 10
    within = _within(spark, wide, prefixes, level)
    order = Window.partitionBy("_pattern").orderBy("_k1", "_k2", "_row")
    rest = _small(spark, {p: v[2] for p, v in open_.items()}, "rest bigint")
    last = (
        within.withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .join(F.broadcast(rest), "_pattern")
        .where("upto > rest")
        .groupBy("_pattern")
        .agg(F.min(F.struct("_k1", "_k2", (F.col("upto") - F.col("size")).alias("words"))).alias("x"))
    )
    for r in last.collect():
        x = r["x"]
        out[r["_pattern"]] = (x["_k1"], x["_k2"], open_[r["_pattern"]][3] + x["words"])
    return out


def _small(spark, values: dict[str, int], schema: str) -> DataFrame:
    return spark.createDataFrame([(k, v) for k, v in values.items()], f"_pattern string, {schema}")


def _within(spark, wide: DataFrame, prefixes: dict[str, list[int]], level: int) -> DataFrame:
    """Rows of the open patterns whose leading groups of bits are those of the pattern's cut."""
    rows = spark.createDataFrame([(p, v) for p, v in prefixes.items()], "_pattern string, _prefix array<bigint>")
    return wide.join(F.broadcast(rows), "_pattern").where(F.slice("_bits", 1, level) == F.col("_prefix")).drop("_prefix")


def _chosen(rows: DataFrame, rests: dict[str, int]) -> dict[str, list[tuple[int, int, int]]]:
    """Of each pattern the cuts (first key, second key, size): documents below a cut and of at most its
    size are chosen. In the order, each is one that still fits; in the end no other does."""
    spark = rows.sparkSession
    out, missing, here, rounds = {p: [] for p in rests}, {p: r for p, r in rests.items() if r > 0}, rows, 0
    while missing and (FILLS is None or rounds <= FILLS):
        rounds += 1
        cuts = _cuts(here, missing)
        for p, (c1, c2, taken) in cuts.items():
            if c1 >= 0:
                out[p].append((c1, c2, missing[p]))
            missing[p] -= taken
        missing = {p: m for p, m in missing.items() if m > 0 and 0 <= cuts[p][0] < _END}
        # What is left below the cut is longer than what was missing then.
        want = spark.createDataFrame([(p, m, *cuts[p][:2]) for p, m in missing.items()], "_pattern string, m bigint, c1 bigint, c2 bigint")
        fits = "size > 0 and size <= m and (_k1 > c1 or _k1 = c1 and _k2 >= c2)"
        here = rows.join(F.broadcast(want), "_pattern").where(fits).drop("m", "c1", "c2")
    return out


def mix(
    docs: DataFrame,
    sources: Column,
    key: Sequence[str],
    size: Column | None = None,
    weight: Callable[[int], float] = lambda i: 1 + i % 3,
    uses: int = 3,
    seed: int = 0,
) -> DataFrame:
    """docs with size (the words of the column text, if not given), source_size and target (of the first of its sources) and taken.

    sources is an array of names; weight gets the place of a source in code-point order, null last.
    taken = size x the number of uses of the document; 0 leaves it out. The order of documents
    depends on the columns of key and the seed only; copies with equal keys are taken one by one.
    """
    spark = docs.sparkSession
    plain = docs.drop("size", "source_size", "target", "taken")
    # Each row gets a number that stays: it tells equal rows apart.
    numbered = stored(
        plain.withColumns({"_sources": F.array_sort(F.array_distinct(sources)), "size": words(F.col("text")) if size is None else size}).withColumns(
            {
                "_row": F.monotonically_increasing_id(),
                "_pattern": F.to_json(F.struct("_sources")),
                "_k1": F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 4),
            }
        ),
        "mix",
    )
    numbered = numbered.withColumn("_k2", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "_row"), 4))
    found = numbered.groupBy("_pattern", "_sources").agg(F.sum("size").alias("words")).collect()
    if not found:
        return plain.withColumns({"size": F.lit(0).cast("bigint"), "source_size": F.lit(0).cast("bigint"), "target": F.lit(0.0), "taken": F.lit(0).cast("bigint")})
    sizes: dict = {}
    for r in found:
        for s in r["_sources"]:
            sizes[s] = sizes.get(s, 0) + r["words"]
    total = sum(r["words"] for r in found)
    goal = targets(sizes, weight, uses) if total else dict.fromkeys(sizes, 0.0)
    patterns = {r["_pattern"]: (r["_sources"], r["words"]) for r in found}
    taken = flow({s: round(t) for s, t in goal.items()}, patterns, uses)
    whole = {p: min(uses, taken[p] // w) if w else 0 for p, (_, w) in patterns.items()}
    rests = {p: taken[p] - whole[p] * patterns[p][1] for p in patterns}
    slim = numbered.select("_pattern", "_k1", "_k2", "_row", "size")
    cuts = _chosen(slim, rests)
    rows = [(p, sizes[s[0]], goal[s[0]], whole[p], cuts[p]) for p, (s, _) in patterns.items()]
    schema = "_pattern string, source_size bigint, target double, _whole bigint, _cuts array<struct<c1: bigint, c2: bigint, m: bigint>>"
    # One row per pattern, which the driver holds anyway.
    decided = numbered.join(F.broadcast(spark.createDataFrame(rows, schema)), "_pattern")
    extra = F.expr("exists(_cuts, c -> size <= c.m and (_k1 < c.c1 or _k1 = c.c1 and _k2 < c.c2))").cast("bigint")
    return decided.withColumn("taken", F.col("size") * (F.col("_whole") + extra)).select(
        *plain.columns, "size", "source_size", "target", "taken"
    )
