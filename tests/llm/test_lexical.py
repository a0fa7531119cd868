"""op12 against plain scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourly_demand.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(i, c) for i, t in docs if (c := Counter(terms(t)))]
    n_docs, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for i, c in held:
            m = 25 + (75 * c.total() * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c
            )
            if score:
                found.append((score, i))
        found.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, r + 1, i, s) for r, (s, i) in enumerate(found[:k])]
    return Counter(out)


def words(rng, count):
    return " ".join(f"w{min(int(rng.paretovariate(0.6)), 4000)}" for _ in range(count))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    docs = [(i, words(rng, int(rng.paretovariate(0.9) * 8))) for i in range(600)]
    docs += [(1000, None), (1001, ""), (1002, " .,- "), (1003, "É é ÉTÉ w1 W1 w1"), (None, "w7 w9 only here"), (1004, "w7 w9 only here"), (1005, words(rng, 60_000))]
    docs += [(1006, "tie tie tie")] * 2 + [(i, "tie tie tie") for i in (1020, 1010)] + [(3, "w1 w2 another text of an id")] + [(2000 + i, "hot hot copy w5") for i in range(300)]
    items = [(i, words(rng, rng.randint(1, 40))) for i in range(30)]
    items += [(100, None), (101, ""), (102, "zzz nowhere"), (103, "É, été! É"), (104, "tie"), (104, "tie"), (104, "w9 only"), (None, "w9 only"), (105, "hot copy"), (106, words(rng, 500))]
    return docs, items


def found(spark, docs, items, k=10, **options):
    a = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, row string, score int")
    b = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id bigint, text string, rank int")
    return Counter(tuple(r) for r in lexical.search(a, b, k, **options).select("item_id", "rank", "doc_id", "score").collect())


def test_search(spark, corpus):
    assert found(spark, *corpus) == brute(*corpus)


def test_several_passes_joined_documents_and_small_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 7)
    monkeypatch.setattr(lexical, "TERMS", 60)
    monkeypatch.setattr(lexical, "SENT", 0)
    monkeypatch.setattr(lexical, "PILOTS", 1)
    assert found(spark, *corpus, k=3) == brute(*corpus, k=3)


@pytest.mark.parametrize("bits, docs", [(1, 4096), (12, 16)])
def test_crowded_signatures_only_cost_time(spark, corpus, monkeypatch, bits, docs):
    """Also if nearly all bits are wrong."""
    import pyarrow as pa

    monkeypatch.setattr(lexical, "WIDTH_BITS", bits)
    monkeypatch.setattr(lexical, "BLOCK_DOCS", docs)
    held = [(i, lexical.term_counts((t or "").encode())) for i, t in enumerate(t for _, t in corpus[0])]
    window = lexical._Window()
    for i, c in held:
        if c:
            window.add(i, c)
    n_docs, total = len(window.rows), sum(c.total() for _, c in held)
    weights = [{t.encode(): 1000 + len(t) for t in terms(text)} for _, text in corpus[1]]
    items = lexical.Items(list(range(len(weights))), weights, n_docs, total)
    bounds = lexical.Bounds(items)
    for width, rows, n, most, packed, *_ in window.blocks():
        upper = bounds.of(width, n, most, pa.py_buffer(packed))
        exact = np.array([[items.score(q, held[r][1], int(items.length(held[r][1].total()))) for r in rows] for q in range(len(weights))])
        assert (upper >= exact).all()


def test_bounds_rule_most_documents_out(spark, corpus):
    docs = spark.createDataFrame(corpus[0], "doc_id bigint, text string")
    blocks = lexical.index(docs)
    assert blocks.agg(F.sum(F.size("row"))).first()[0] == sum(bool(terms(t)) for _, t in corpus[0])
    df = dict(blocks.where("terms is not null").select(F.explode(F.arrays_zip("terms", "df")).alias("t")).groupBy("t.terms").agg(F.sum("t.df")).collect())
    assert df == Counter(t for _, text in corpus[0] for t in set(terms(text)))


def test_terms_of_long_texts(monkeypatch):
    text = ("Ab c-d_é9 " * 50 + "x" * 100 + " Ü! ") * 20
    want = Counter(t.encode() for t in terms(text))
    for piece in (1, 7, 64, 10**6):
        monkeypatch.setattr(lexical, "PIECE", piece)
        assert lexical.term_counts(text.encode()) == want
    assert lexical.term_counts(b"") == lexical.term_counts(b" \n") == Counter()


def test_empty_tables(spark):
    assert not found(spark, [], [(1, "a")])
    assert not found(spark, [(1, "a")], [])
    assert not found(spark, [(1, None)], [(1, "a")])
    # A term in every document has a weight of 0 only in large corpora.
    assert found(spark, [(1, "a")], [(1, "a")]) == brute([(1, "a")], [(1, "a")])
