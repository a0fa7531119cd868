"""op3 against brute force."""

import random
import sys

import numpy as np
import pandas as pd
import pytest
import xxhash
from llm_helpers import by_id
from pyspark.sql import functions as F

from hourly_demand.llm import simhash
from hourly_demand.llm.components import components


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words, word = [], ""
    for c in lower + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, distance):
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for a in fps:
        for b in fps:
            if bin(a ^ b).count("1") <= distance:
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {f: root(f) for f in fps}


def texts(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(rng.randint(1, 60))]
        out.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            again = list(words)
            again[rng.randrange(len(again))] = "X" + str(i)
            out.append(rng.choice([" ", "\n\t "]).join(again))
    return out


def test_near_duplicates(make):
    rows = [(i, t) for i, t in enumerate(texts(40, 1))]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (903, "one"), (None, "one"), (None, "lonely " * 9), (905, "w " * 30000), (906, "\x85a b c d e")]
    fps = [brute_fingerprint(t or "") for _, t in rows]
    roots = brute_components(set(fps), 4)
    low = {}
    for (i, _), f in zip(rows, fps, strict=True):
        if i is not None:
            low[roots[f]] = min(low.get(roots[f], i), i)
    got = simhash.near_duplicates(make(rows, extra="fp"))
    want = sorted((str(i), f"{f:016x}", str(low.get(roots[f]))) for (i, _), f in zip(rows, fps, strict=True))
    found = got.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("h"), "component_id").collect()
    assert sorted((str(r["doc_id"]), r["h"], str(r["component_id"])) for r in found) == want


@pytest.mark.parametrize("joined, block", [(64, 2048), (0, 2048), (0, 3)])
def test_links_connect_what_pairs_connect(spark, monkeypatch, joined, block):
    monkeypatch.setattr(simhash, "JOINED", joined)
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(7)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for f in list(fps)[:10]:
        for _ in range(12):
            g = f
            for _ in range(rng.randint(1, 6)):
                g ^= 1 << rng.randrange(64)
            fps.add(g)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp bigint"))
    pairs = {tuple(r) for r in links.collect()}
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 4 and a != b for a, b in pairs)
    label = {f: f for f in signed}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for a, b in pairs:
        x, y = root(a), root(b)
        label[max(x, y)] = min(x, y)
    want = brute_components(fps, 4)
    groups = lambda d: {frozenset(k for k in d if d[k] == v) for v in set(d.values())}
    assert groups({f % 2**64: root(f) for f in signed}) == groups(want)


def test_segments_have_to_cover(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.range(1).withColumnRenamed("id", "fp"), 5)


def test_one_of_each(make):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None), (4, ""), (5, "other words than these before"), (5, "again something else for the same key"), (None, "no key here at all")]
    got = sorted((str(r["doc_id"]), r["text"]) for r in simhash.one_of_each(make(rows)).collect())
    assert got == sorted([("1", "a b c d e f"), ("2", "None")][:1] + [("5", rows[5][1]), ("5", rows[6][1]), ("None", rows[7][1])] + [(g, t) for g, t in got if g in "24"])
    assert sum(g in ("2", "4") for g, _ in got) == 1


def test_empty_table(make):
    assert simhash.near_duplicates(make([])).count() == 0
    assert simhash.one_of_each(make([])).count() == 0


def test_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + rng.randint(1, 40)) for _ in range(60)]
    links = [*chain, *star, (5000, 5000), (7, None), (2000, 2001), (2001, 2000), (2000, 2001)]
    rng.shuffle(links)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(61)} | {n: 1000 for e in star for n in e} | {2000: 2000, 2001: 2000}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_spanning_is_a_forest():
    fps = np.array([0, 1, 3, 7, 15, 31, 63], dtype=np.int64)
    assert len(simhash.spanning(fps, fps, 1)) == 6
    assert isinstance(simhash.spanning(fps[:0], fps, 1), pd.DataFrame)


def test_extra_columns(make):
    got = simhash.one_of_each(make([(1, "a b c")], extra="component_id"))
    assert by_id(got, "component_id") == {1: "old"}


def test_rows_per_fingerprint_are_never_broadcast(spark, make, tmp_path, monkeypatch):
    make(list(enumerate(texts(20, 5)))).write.parquet(str(tmp_path / "docs"))
    docs, plans = spark.read.parquet(str(tmp_path / "docs")), {}

    def watched(df, name, keep=simhash.stored):
        plans.setdefault(name, "")
        plans[name] += df._jdf.queryExecution().executedPlan().toString()
        return keep(df, name)

    for module in (simhash, sys.modules[components.__module__]):
        monkeypatch.setattr(module, "stored", watched)
    # Only a counted number of very large buckets may be sent.
    monkeypatch.setattr(simhash, "BROADCAST_ROWS", -1, raising=False)
    found = simhash.near_duplicates(docs)
    plans["result"] = found._jdf.queryExecution().executedPlan().toString()
    assert found.select("component_id").distinct().count() == simhash.one_of_each(docs).count()
    assert {"lookups", "links", "near-components", "kept", "result"} <= set(plans)
    assert [n for n, p in plans.items() if "BroadcastHashJoin" in p] == []
