"""op11 against a plain tree."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hourly_demand.llm import lines, merkle
from hourly_demand.llm.queries import LEAF

FIFTH = "crc32(cast(doc_id AS string)) % 5 = 0"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def low(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def path(levels, at, fanout):
    out = []
    for level in levels[:-1]:
        first = at // fanout * fanout
        out.append((level[first:at], level[at + 1 : first + fanout]))
        at //= fanout
    return out


def brute(rows, fanout=16):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(*map(field, r))))
        trees[s] = tree([digest(*map(field, r)) for r in groups[s]], fanout)
    top = tree([trees[s][-1][0] for s in names], fanout)
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            sides = path(trees[s], i, fanout) + path(top, k, fanout)
            tried = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            h = digest(*map(field, (*r[:4], low(r[4])))) if tried else trees[s][0][i]
            for left, right in sides:
                h = digest(*left, h, *right)
            proof = digest(*[x for left, right in sides for x in (*left, *right)])
            out.append((r[0], trees[s][0][i], trees[s][-1][0], top[-1][0], proof, h, h == top[-1][0]))
    return Counter(out)


def proven(df, **options):
    return merkle.prove(df, LEAF, {"text": lines.lowered(F.col("text"))}, F.expr(FIFTH), **options)


def rows_of(df):
    return [tuple(r) for r in df.select(*LEAF).collect()]


ROWS = [(i, f"Text {i} É", f"s{i % 3}") for i in range(70)]
ODD = [(None, None, None), (None, "x", None), (5, "Text 5 É", "s2"), (5, "Other", "s2"), (900, "", "alone"), (901, "L" * 300_000, "Ü"), (902, "a\nB", "")]


@pytest.mark.parametrize("fanout, every", [(16, 2), (2, 2), (2, 1), (3, 3)])
def test_manifest(make, monkeypatch, fanout, every):
    monkeypatch.setattr(merkle, "FANOUT", fanout)
    df = make(ROWS + ODD + [(5, "Text 5 É", "s2")] * 3, extra="leaf").withColumn("path", F.lit(1))
    got = Counter(tuple(r) for r in proven(df, every=every).collect())
    want = brute(rows_of(df), fanout)
    # Rows that are equal stand side by side, in any order: their proofs are the same as a set.
    assert got == want
    assert sum(not r[-1] for r in got.elements()) > 5


def test_nulls_in_every_column(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    df = spark.createDataFrame([(None,) * 5, (None,) * 5, (1, "A", None, "s", None), (1, None, "en", None, -3)], schema)
    assert Counter(tuple(r) for r in proven(df).collect()) == brute(rows_of(df))


def test_one_row_and_no_row(make):
    one = proven(make([(7, "Alone")])).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == digest()
    none = proven(make([]))
    assert none.count() == 0 and none.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_hot_group_is_spread(make, monkeypatch):
    df = make([(i, "t", "hot" if i % 3 else f"s{i % 30}") for i in range(3000)])
    leaves = df.select(F.col("source").alias("grp"), F.col("doc_id").alias("key"), F.md5("text").alias("h"))
    placed = merkle.numbered(leaves, "grp", ["key", "h"]).toPandas()
    for _, part in placed.groupby("grp"):
        assert part.sort_values("key")["pos"].tolist() == list(range(len(part))) and set(part["n"]) == {len(part)}
    largest = merkle._subtrees(merkle.numbered(leaves, "grp", ["key", "h"]), "grp", 2).agg(F.max(F.size("kids"))).first()[0]
    assert largest == 256


def test_a_changed_field_changes_the_root(make):
    root = lambda rows: proven(make(rows)).first()["root"]
    assert root(ROWS) == root(ROWS[::-1])
    assert root(ROWS) != root([*ROWS[:-1], (69, "text 69 É", "s0")]) != root(ROWS[:-1])
