"""op9: planted passages, similarity against brute force, defined results."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from llm_helpers import by_id
from pyspark.sql import functions as F

from hourly_demand.llm import substrings


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def spread(seq, seed):
    """Words with blanks and line ends between them."""
    rng = random.Random(seed)
    return "".join(w + rng.choice([" ", " ", " ", "\n", "  "]) for w in seq)


PASSAGE = words(60, 999)
SHORT = words(30, 998)


@pytest.fixture(scope="module")
def planted():
    docs = {}
    for i in range(30):
        own = words(200, i)
        if i % 3 == 0:
            own[50:50] = PASSAGE
        if i % 3 == 1:
            own[20:20] = SHORT
        docs[i] = spread(own, i)
    return docs


def test_planted_passages_leave_all_but_one(make, planted):
    got = substrings.dedup(make(list(planted.items()), extra="spans")).collect()
    text = " ".join(PASSAGE)
    holders = [r["doc_id"] for r in got if text in " ".join(r["text"].split())]
    assert holders == [0]
    for r in got:
        own = " ".join(words(200, r["doc_id"]))
        if r["doc_id"] % 3 == 0 and r["doc_id"]:
            assert " ".join(r["text"].split()) == own
            assert r["removed_words"] == 60 and r["kept_in"] == [0] and r["clusters"]
            (span,) = r["spans"]
            assert " ".join(planted[r["doc_id"]][span["start"] : span["end"]].split()) == text
        else:
            assert r["text"] == planted[r["doc_id"]] and r["removed_words"] == 0 and r["spans"] is None


def test_passage_of_just_over_fifty_words_anywhere(make):
    rows = []
    for i in range(40):
        passage, at = words(51, 500 + i), i * 3
        for k in range(2):
            own = words(140, 1000 + 2 * i + k)
            own[at : at] = passage
            rows.append((2 * i + k, spread(own, i + k)))
    got = by_id(substrings.dedup(make(rows)), "removed_words")
    assert all(got[2 * i] == 0 for i in range(40))
    assert all(got[2 * i + 1] >= 51 for i in range(40))


def test_columns_with_names_of_its_own(make):
    from pyspark.sql import functions as F

    df = make([(1, spread(PASSAGE, 1)), (2, spread(PASSAGE, 2))], extra="row").withColumn("words", F.lit("w")).withColumn("cluster", F.lit(5))
    out = substrings.dedup(df).orderBy("doc_id").collect()
    assert [(r["row"], r["words"], r["cluster"]) for r in out] == [("old", "w", 5)] * 2 and out[0]["removed_words"] == 0


def test_odd_rows(make):
    long = spread(words(30_000, 5), 5)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "the " * 3000), (5, "the " * 3000), (6, long), (7, long), (8, "a b"), (9, "a b"), (None, spread(PASSAGE, 1)), (10, spread(PASSAGE, 2))]
    rows += [(11, spread(words(100, 77), 1))] * 3
    got = substrings.dedup(make(rows)).collect()
    assert len(got) == len(rows)
    found = {(r["doc_id"], r["n_chars"]): r for r in got}
    by = {r["doc_id"]: r for r in got}
    assert by[1]["text"] is None and by[2]["text"] == "" and by[8]["text"] == by[9]["text"] == "a b"
    assert by[6]["text"] == long and by[7]["text"].strip() == "" and by[7]["removed_words"] == 30_000
    assert by[5]["text"].strip() == "" and by[4]["removed_words"] == 0
    # A document without a key comes last; equal rows keep their text.
    assert by[None]["text"].strip() == "" and by[10]["removed_words"] == 0
    assert [r["removed_words"] for r in got if r["doc_id"] == 11] == [0, 0, 0] and found


def test_empty_table(make):
    assert substrings.dedup(make([])).count() == 0


def brute_jaccard(a, b):
    x, y = (set(zip(*[s.split(" ")[k:] for k in range(5)], strict=False)) or {s} for s in (a, b))
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("joined, block", [(16, 512), (0, 512), (0, 4)])
def test_links_are_the_similar_pairs(spark, monkeypatch, joined, block):
    monkeypatch.setattr(substrings, "JOINED", joined)
    monkeypatch.setattr(substrings, "BLOCK", block)
    rng = random.Random(1)
    texts = []
    for i in range(12):
        base = words(40, i)
        texts.append(" ".join(base))
        for _ in range(4):
            other = list(base)
            other[rng.choice([0, 1, 39, 20])] = f"x{rng.randint(0, 5)}"
            texts.append(" ".join(other))
    texts = sorted(set(texts))
    rows = [(i, [0], t) for i, t in enumerate(texts)]
    links = substrings._links(spark.createDataFrame(rows, "id bigint, keys array<bigint>, words string"), 0.8)
    pairs = {tuple(r) for r in links.collect()}
    assert all(brute_jaccard(texts[a], texts[b]) >= 0.8 for a, b in pairs)

    def groups(edges):
        label = list(range(len(texts)))
        for _ in texts:
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        return label

    want = [(a, b) for a in range(len(texts)) for b in range(a) if brute_jaccard(texts[a], texts[b]) >= 0.8]
    assert groups(pairs) == groups(want)
    assert 0 < len(pairs) <= max(len(want), 1)


def test_band_keys_meet_at_the_similarity(monkeypatch):
    rng, met, total = random.Random(2), 0, 0
    monkeypatch.setattr(substrings, "REACH", 10**6)  # one paragraph per text
    for i in range(300):
        a = words(30, i)
        b = [*a[:-1], "other"]
        keys = []
        for t in (a, b):
            data = np.frombuffer(" ".join(t).encode(), np.uint8)
            cut = substrings.Cut(data, np.array([0, len(data)]))
            cut.opens = np.array([0])
            keys.append(cut.keys()[2][:, 0])
        met += bool((keys[0] == keys[1]).any())
        total += 1
        rng.random()
    assert met / total > 0.95


def test_cuts_depend_on_near_words_only():
    inner = words(80, 3)
    seen = []
    for k in range(2):
        t = words(30 + 7 * k, 50 + k) + inner + words(40, 60 + k)
        data = np.frombuffer(" ".join(t).encode(), np.uint8)
        cut = substrings.Cut(data, np.array([0, len(data)]))
        at = cut.opens - (30 + 7 * k)
        seen.append([o for o in at.tolist() if 7 <= o < 72])
    assert seen[0] == seen[1] and seen[0]


def test_native_similarity(spark):
    df = spark.createDataFrame([("a b c d e f", "a b c d e g"), ("a b", "a b"), ("a b", "b a")], "a string, b string")
    got = [r[0] for r in df.select(substrings.jaccard(substrings.shingles(F.col("a")), substrings.shingles(F.col("b")))).collect()]
    assert got == pytest.approx([1 / 3, 1, 0])
    assert isinstance(substrings.spanning(pd.DataFrame({"id": [1], "words": ["a"]}), pd.DataFrame({"id": [2], "words": ["a"]}), 0.8), pd.DataFrame)


def test_edited_passages_leave_too(make):
    rows, edits = [], [(60, [30]), (90, [45]), (300, [50, 100, 150, 200, 250])]
    for i in range(30):
        n, at = edits[i % 3]
        passage = words(n, 300 + i)
        edited = [f"new{i}" if k in at else w for k, w in enumerate(passage)]
        for k, p in enumerate((passage, edited)):
            own = words(120, 700 + 2 * i + k)
            rows.append((2 * i + k, spread([*own[: 3 * i], *p, *own[3 * i :]], i + k)))
    got = by_id(substrings.dedup(make(rows)), "removed_words", "kept_in")
    for i in range(30):
        assert got[2 * i][0] == 0
        assert got[2 * i + 1] == (edits[i % 3][0], [2 * i])


def test_passages_with_more_edits_stay(make):
    # Every eighth word differs: a Jaccard of about 0.23.
    passage = words(90, 4)
    edited = [f"new{k}" if k % 8 == 4 else w for k, w in enumerate(passage)]
    rows = [(k, spread([*words(60, 20 + k), *p, *words(60, 30 + k)], k)) for k, p in enumerate((passage, edited))]
    assert all(r["removed_words"] == 0 for r in substrings.dedup(make(rows)).collect())


@pytest.mark.parametrize("least", [50, 51, 55])
def test_every_passage_holds_a_whole_paragraph(least):
    texts = [words(40, 3 * i) + words(least, 3 * i + 1) + words(40, 3 * i + 2) for i in range(2000)]
    data = [" ".join(t).encode() for t in texts]
    cut = substrings.Cut(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(d) for d in data]))
    place = cut.opens - cut.text[cut.opens] * (80 + least) - 40
    # Cuts that depend on words of the passage only; two of them have a paragraph between them.
    stable = (place >= substrings.REACH) & (place < least - substrings.REACH)
    assert np.bincount(cut.text[cut.opens[stable]], minlength=2000).min() >= 2


def test_passages_of_fifty_words_all_leave(make):
    rows = []
    for i in range(40):
        passage, at = words(50 + i % 3, 500 + i), i * 3
        for k in range(2):
            own = words(140, 1000 + 2 * i + k)
            own[at:at] = passage
            rows.append((2 * i + k, spread(own, i + k)))
    got = by_id(substrings.dedup(make(rows)), "removed_words")
    assert [i for i in range(40) if got[2 * i + 1] < 50] == []


def test_one_run_needs_no_shingles():
    # A run is the same words in both, and no part of a chain is longer than the whole.
    assert substrings.similar(None, None, [(3, 5, 46)], 0.8, 50) == [(3, 53)]
    assert substrings.similar(None, None, [(3, 5, 45)], 0.8, 50) == []
    assert substrings.similar(None, None, [(3, 5, 20), (28, 30, 20)], 0.8, 50) == []


def test_passages_of_slices_equal_those_of_the_whole(spark):
    class Frame:
        def select(self, *columns):
            return self

        def mapInArrow(self, function, schema):
            return function

    passage = " ".join(f"word{i}" for i in range(60))
    seed = {"number": 0, "k_number": 2, "cluster": 7}
    # The kept stretch opens its paragraph 2 with the passage; the other one has nothing of it.
    same = {"none": False, "keeper": 5, "k_first": 2, "seeds": [seed], "offsets": "0", "words": passage}
    other = same | {"keeper": 6, "seeds": [seed | {"cluster": 8}], "words": " ".join(f"other{i}" for i in range(60))}
    texts = [passage.upper(), f"{passage} end", passage + ", " * 3]
    stretches = [[same], [other, same], [other]]
    kind = pa.list_(pa.struct([("none", pa.bool_()), ("keeper", pa.int64()), ("k_first", pa.int32()), ("seeds", pa.list_(pa.struct([("number", pa.int32()), ("k_number", pa.int32()), ("cluster", pa.int64())]))), ("offsets", pa.string()), ("words", pa.string())]))
    whole = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(texts), pa.array(stretches, kind)], names=["row", "text", "stretches"])
    cut = substrings._passages(Frame(), "text", 0.8, 50, "bigint")
    found = [r for batch in cut(iter([whole])) for r in batch.to_pylist()]
    assert [(r["row"], r["removed_words"], r["clusters"], r["kept_in"]) for r in found] == [(1, 60, [7], [5]), (2, 60, [7], [5])]
    assert found[1]["spans"] == [{"start": 0, "end": len(passage)}]
    assert [r for i in range(3) for batch in cut(iter([whole.slice(i, 1)])) for r in batch.to_pylist()] == found


def test_shingles_of_texts_are_numbered_together():
    rng = np.random.default_rng(3)
    # So many words that five of them do not fit one number, and so few that they do.
    for size in (40, 9000):
        texts = [" ".join(f"w{k}" for k in rng.integers(0, size, n)).encode() for n in (0, 3, 5, 400, 12000)]
        texts.append(texts[3])
        made = substrings._runs_of_words(texts)
        shingles = [[tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)] for t in texts]
        assert [len(m) for m in made] == [len(s) for s in shingles]
        pairs = {(a, b) for m, s in zip(made, shingles, strict=True) for a, b in zip(m, s, strict=True)}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
