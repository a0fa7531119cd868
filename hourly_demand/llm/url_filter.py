"""URL filter lists by Bloom filter cascades, with DataFrame functions only.

A rule is a host and the start of a path. It fits a url whose host is the rule's or lies below it
and whose path starts with the rule's. So a url has a few candidate keys: each suffix of its host
with at most as many labels as a rule has, joined to each start of its path that is as long as
some rule's. The url fits a rule exactly if the rule is among these keys.

Which keys are listed is answered without a join by a cascade of Bloom filters per action: level 1
encodes the listed keys, level 2 those keys of the corpus that level 1 takes for listed but are not,
level 3 the listed keys that level 2 takes for such, and so on until nothing is left. For every key
of the corpus, and for every listed key, the answer is exact.

The filters are literals in the plan. Level 1 is sized so that it lets some 0.7 x the number of
listed keys through, whatever the size of the corpus, so all levels together take
O(listed keys x log(corpus keys / listed keys)) bits; the lists are the only thing that grows them.

Null urls and urls without `://` have an empty host and path and fit no rule. Repeated rows and
extra columns stay; columns named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, stored


class Rule(NamedTuple):
    action: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


class Level(NamedTuple):
    seed: int
    hashes: int
    bits: int
    words: list[int]

    def holds(self, key: Column) -> Column:
        literal = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        found = [
            F.getbit(F.get(literal, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1
            for at in self.places(key)
        ]
        out = found[0]
        for x in found[1:]:
            out = out & x
        return out

    def places(self, key: Column) -> list[Column]:
        return [_place(key, self.seed, i, self.bits) for i in range(self.hashes)]


def _place(key: Column, seed: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed * 1000 + i)), F.lit(bits).cast("bigint"))


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; empty without ://."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ? # or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def keys(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Candidate keys of a url: host suffixes x path starts, as long as rules have them."""
    labels = max((r.host.count(".") + 1 for r in rules), default=1)
    lengths = sorted({len(r.path) for r in rules})
    parts = F.split(host, r"\.")
    count = F.size(parts)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(count, F.lit(labels))),
        lambda n: F.array_join(F.slice(parts, count - n + 1, n), "."),
    )
    starts = F.array_compact(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p))))


def _level(keys_of: DataFrame, count: int, seed: int, rate: float) -> Level:
    """A Bloom filter over the column key, built by one aggregation to words of 64 bits."""
    hashes = max(1, round(math.log2(1 / rate)))
    bits = 64 * max(1, math.ceil(count * hashes / math.log(2) / 64))
    empty = Level(seed, hashes, bits, [])
    at = keys_of.select(F.explode(F.array(*empty.places(F.col("key")))).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")
    )
    full = [0] * (bits // 64)
    for row in words.collect():  # bounded by the size of the filter
        full[row["word"]] = row["bits"]
    return empty._replace(words=full)


def cascade(listed: DataFrame, corpus: DataFrame) -> list[Level]:
    """Levels that tell the listed keys from all other keys of the corpus. Both have a column key."""
    count = listed.count()
    if not count:
        return []
    universe = corpus.agg(F.approx_count_distinct("key").alias("n")).first()["n"]
    rate = min(0.5, count * math.sqrt(0.5) / max(universe, 1))
    levels = [_level(listed, count, 1, rate)]
    through = corpus.where(levels[0].holds(F.col("key"))).distinct()
    # The listed keys leave through a hash join on the few keys that came through, never on the corpus.
    inside, outside = stored(through.join(listed, "key", "left_anti"), "cascade"), listed
    while count := inside.count():
        levels.append(_level(inside, count, len(levels) + 1, 0.5))
        inside, outside = outside.where(levels[-1].holds(F.col("key"))), inside
    return levels


def member(key: Column, levels: Sequence[Level]) -> Column:
    """In level 1, and not (in level 2, and not (in level 3 ...))."""
    out = F.lit(False)
    for level in reversed(levels):
        out = level.holds(key) & ~out
    return out


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """pages with host, path, rule (host and path of the longest fitting rule) and verdict.

    A url that fits no rule is not listed: allow. Where both actions list one key, block counts.
    """
    spark = pages.sparkSession
    parts = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    # A null url takes part as an empty one.
    parts = parts.withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "path")})
    if not rules:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    corpus = parts.select(F.explode(keys(F.col("host"), F.col("path"), rules)).alias("key"))
    levels = {action: cascade(_listed(spark, rules, action), corpus) for action in ("allow", "block")}

    def fit(key: Column) -> Column:
        listed = F.when(member(key, levels["block"]), F.lit("block")).when(member(key, levels["allow"]), F.lit("allow"))
        return let(listed, lambda a: F.when(a.isNotNull(), F.struct(F.length(key).alias("n"), a.alias("verdict"), key.alias("rule"))))

    best = F.array_max(F.array_compact(F.transform(keys(F.col("host"), F.col("path"), rules), fit)))
    judged = parts.withColumn("_best", best)
    return judged.withColumns({"rule": F.col("_best.rule"), "verdict": F.coalesce(F.col("_best.verdict"), F.lit("allow"))}).drop("_best")


def _listed(spark: SparkSession, rules: Sequence[Rule], action: str) -> DataFrame:
    keys_of = sorted({r.key for r in rules if r.action == action})
    return spark.createDataFrame([(k,) for k in keys_of], "key string")
