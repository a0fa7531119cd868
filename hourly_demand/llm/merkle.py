"""Merkle manifest of a dataset: a tree per group, a tree over the groups, and a proof for every row.

H is the lowercase hex SHA-256 of its inputs joined; digests enter as hex text. A row's leaf is H of
its fields, each `-` if null, else its UTF-8 bytes, `:` and the value. The leaves of a group ascend by
key; every FANOUT consecutive nodes, the last run as many as are left, become their H, until one node
remains: the subroot (a lone leaf itself). The subroots, by group (null first, bytewise), make the root alike.

Checkpoint and recompute: of each tree only every `every`-th level is written. A written node covers an
aligned subtree of FANOUT ** every written nodes below it, so the levels between exist only inside the
aggregate that gathers such a subtree, which has a bounded number of nodes however large a group is.
Proofs go from the top down: a subtree is gathered again, its missing interior nodes are made anew,
each node below gets the siblings of its own run, those of its regenerated ancestors, and what its
stored ancestor got before; then the interior nodes are gone.

Positions come from a range sort on group, key and leaf (equal rows are dealt out by a further hash,
they may stand in any order), counts per sorted part, and running sums of these counts; no group is
gathered for it, and texts are not moved, as leaves are made where the rows are read.

Null keys come first in their group. Rows that repeat are leaves of their own. An empty table has no
rows and no root. Extra columns do not enter and are not returned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import let, stored

FANOUT = 16
#: Levels from one that is written to the next.
EVERY = 2
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field as it enters a leaf; numbers in decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return digest(*[field(f) for f in fields])


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """rows with pos, their place in their group from 0, and n, the rows of the group; stored."""
    dealt = rows.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    order = [group, *order, "_salt"]
    sorted_rows = dealt.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    # The id is the part's number and the place in it.
    placed = stored(sorted_rows.drop("_salt").withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_at", 33)
    runs = placed.groupBy(F.col(group).alias("_group"), part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # A row per sorted part and group: parts are as many as the sort made tasks, groups add one each.
    along = Window.partitionBy("_group").orderBy("_part")
    before = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumns({"_before": F.coalesce(before, F.lit(0)), "n": F.sum("_n").over(Window.partitionBy("_group"))})
    same = F.col(group).eqNullSafe(F.col("_group")) & (part == F.col("_part"))
    joined = placed.join(runs.drop("_n"), same)
    return joined.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_group", "_part", "_first", "_before")


def _runs(nodes: Column) -> Column:
    """The next level: H of every FANOUT nodes."""
    each = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(each, lambda i: digest(F.array_join(F.slice(nodes, i * FANOUT + 1, F.lit(FANOUT)), "")))


def _levels_above(nodes: Column, n: Column, every: int, body) -> Column:
    """body(levels): the levels of a subtree from its stored nodes up, `every` + 1 of them. n: nodes of
    the whole group. A level of one node stays as it is if the group has no other: it is the subroot."""

    def climb(levels: list[Column], span: int) -> Column:
        if len(levels) > every:
            return body(levels)
        last = levels[-1]
        above = F.when(n <= span, last).otherwise(_runs(last))
        return let(above, lambda up: climb([*levels, up], span * FANOUT))

    return climb([nodes], 1)


def _subtrees(nodes: DataFrame, group: str, every: int, extra: Sequence[str] = ()) -> DataFrame:
    """Each aligned subtree as one row: block, n and its nodes (at most FANOUT ** every) in order."""
    block = F.expr(f"pos div {FANOUT**every}").alias("block")
    kids = F.sort_array(F.collect_list(F.struct("pos", "h", *extra)))
    return nodes.groupBy(group, "n", block).agg(kids.alias("kids"))


def strata(leaves: DataFrame, group: str, every: int = EVERY) -> list[DataFrame]:
    """The stored levels of the trees of all groups, leaves first: group, pos, h and n, the nodes of
    the group at this level. A group whose level has one node ends there; that node is its subroot."""
    out, width = [leaves], FANOUT**every
    while not (rest := out[-1].where("n > 1")).isEmpty():
        tops = _subtrees(rest, group, every).select(
            group,
            F.col("block").alias("pos"),
            let(F.col("kids.h"), lambda hs: _levels_above(hs, F.col("n"), every, lambda levels: F.get(levels[-1], F.lit(0)))).alias("h"),
            F.expr(f"(n + {width - 1}) div {width}").alias("n"),
        )
        out.append(stored(tops, "stratum"))
    return out


def subroots(levels: Sequence[DataFrame], group: str) -> DataFrame:
    """group and subroot of every group."""
    tops = [s.where("n = 1").select(group, F.col("h").alias("subroot")) for s in levels]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def _siblings(level: Column, at: Column) -> Column:
    """Siblings of the node at a place of its level, in its run: those left and those right of it."""
    inside = F.pmod(at, F.lit(FANOUT))
    return F.struct(
        F.array_join(F.slice(level, at - inside + 1, inside), "").alias("left"),
        F.array_join(F.slice(level, at + 2, FANOUT - 1 - inside), "").alias("right"),
    )


def _own_path(levels: Sequence[Column], at: Column, n: Column) -> Column:
    """Siblings of one node of a subtree, and of its ancestors inside it, upwards."""
    path, span = [], 1
    for level in levels[:-1]:
        # A level of one node is the top: it has no siblings and no level above.
        own = _siblings(level, F.floor(at / span).cast("int"))
        path.append(F.when(n > span, F.array(own)).otherwise(F.array().cast(PATH)))
        span *= FANOUT
    return F.concat(*path)


def _descend(nodes: DataFrame, above: DataFrame, group: str, every: int, extra: Sequence[str], emit) -> DataFrame:
    """emit(kid, path) of every node. above: group, block, path and further columns of the stored
    node over each subtree, or of the group itself where n is 1; they come along."""
    trees = _subtrees(nodes, group, every, extra).withColumn("_level_n", F.col("n")).drop("n")
    upper = above.withColumnsRenamed({group: "_group", "block": "_block"})
    joined = trees.join(upper, trees[group].eqNullSafe(upper["_group"]) & (trees["block"] == upper["_block"])).drop("_group", "_block")

    def emitted(levels: list[Column]) -> Column:
        each = F.sequence(F.lit(0), F.size("kids") - 1)
        one = lambda i: let(
            F.concat(_own_path(levels, i, F.col("_level_n")), F.col("path")), lambda path: emit(F.get("kids", i), path)
        )
        return F.transform(each, one)

    made = let(F.col("kids.h"), lambda hs: _levels_above(hs, F.col("_level_n"), every, emitted))
    kept = [c for c in above.columns if c not in (group, "block", "path")]
    return joined.select(group, *kept, F.explode(made).alias("_of")).select(group, *kept, "_of.*")


def paths(levels: Sequence[DataFrame], tops: DataFrame, group: str, every: int, extra: Sequence[str], emit) -> DataFrame:
    """emit(kid, path) for all leaves (levels[0], with the columns extra), with the columns of tops.

    tops: group, path of the siblings above the subroot, and columns that the leaves get too.
    """
    carried = lambda kid, path: F.struct(kid["pos"].alias("block"), path.alias("path"))
    above = None
    for k in range(len(levels) - 1, -1, -1):
        # Groups that end at this level start from their top; others from the stored node above.
        ends = levels[k].where("n = 1").select(group).join(tops.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g"))).drop("_g")
        ends = ends.withColumn("block", F.lit(0).cast("bigint")).select(group, "block", *[c for c in tops.columns if c != group])
        upper = ends if above is None else above.select(ends.columns).unionByName(ends)
        above = _descend(levels[k], upper, group, every, extra if k == 0 else (), emit if k == 0 else carried)
        if 0 < k < len(levels) - 1:
            above = stored(above, "paths")
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings make."""
    return F.aggregate(path, start, lambda h, s: digest(s["left"], h, s["right"]))


def proof_digest(path: Column) -> Column:
    """H of all siblings, level by level upwards, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(leaves: DataFrame, group: str, order: Sequence[str], every: int = EVERY) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels of the trees of all groups, and tops: group, subroot, root and path above the subroot.

    leaves: group, the columns of order, h (the leaf) and others, which stay on the first level.
    """
    levels = strata(stored(numbered(leaves, group, [*order, "h"]), "leaves"), group, every)
    roots = subroots(levels, group).withColumnsRenamed({group: "name", "subroot": "h"}).withColumn("all", F.lit(0))
    upper = strata(stored(numbered(roots, "all", ["name"]), "subroots"), "all", every)
    root = subroots(upper, "all").select(F.col("all"), F.col("subroot").alias("root"), F.array().cast(PATH).alias("path"))
    found = paths(upper, root, "all", every, ["name"], lambda kid, path: F.struct(kid["name"].alias(group), kid["h"].alias("subroot"), path.alias("path")))
    return levels, stored(found.select(group, "subroot", "root", "path"), "subroot-paths")


def prove(docs: DataFrame, fields: Sequence[str], tampered: dict[str, Column], when: Column, key: str = "doc_id", group: str = "source", every: int = EVERY) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    The fold starts from the row's own leaf, or where `when` holds from the leaf it would have with
    the columns of `tampered` in place of its own.
    """
    changed = leaf([tampered.get(f, F.col(f)) for f in fields])
    leaves = docs.select(
        F.col(group).alias("grp"),
        F.col(key).alias("key"),
        leaf([F.col(f) for f in fields]).alias("h"),
        F.when(F.coalesce(when, F.lit(False)), changed).alias("changed"),
    )
    levels, tops = manifest(leaves, "grp", ["key"], every)

    def emit(kid: Column, path: Column) -> Column:
        start = F.coalesce(kid["changed"], kid["h"])
        return F.struct(kid["key"].alias(key), kid["h"].alias("leaf"), proof_digest(path).alias("proof_sha256"), folded(start, path).alias("folded_root"))

    out = paths(levels, tops, "grp", every, ["key", "changed"], emit)
    return out.select(key, "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
