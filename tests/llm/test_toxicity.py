"""op2: features, held-out accuracy, defined results."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import by_id

from hourly_demand.llm import toxicity


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        bad = rng.random() < 0.25
        if bad:
            for _ in range(rng.randint(1, 3)):
                text.insert(rng.randrange(len(text)), rng.choice(["Vile,", "rotten", "scoundrel!"]))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def labelled(spark):
    docs, labels = corpus(900, 1)
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), {i: t for i, _, t in labels}


def test_held_out_accuracy(make, labelled):
    docs, labels, truth = labelled
    odd = [(9000, None), (9001, ""), (9002, "vile " * 40000), (None, "rotten"), (1, docs[1][1])]
    got = toxicity.judge(make(docs + odd, extra="score"), labels).collect()
    assert len(got) == len(docs) + len(odd)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["held_out"] == (bool(key) and zlib.crc32(key.encode()) % 3 == 1)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    right = np.mean([r["predicted"] == truth[r["doc_id"]] for r in held])
    assert len(held) > 200 and right > 0.95
    scores = {r["doc_id"]: r["score"] for r in got}
    assert scores[9000] == scores[9001] < 0.5 < scores[9002]


def test_labels_of_held_out_rows_do_not_matter(spark, make, labelled):
    docs, labels, truth = labelled
    turned = spark.createDataFrame(
        [(i, 1, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in truth.items()] + [(5000, None, None), (None, 1, 1)],
        "doc_id bigint, quality int, toxic int",
    )
    few = make(docs[:50])
    one = by_id(toxicity.judge(make(docs), labels), "score")
    two = by_id(toxicity.judge(make(docs), turned), "score")
    assert one == two and few.count() == 50


def test_without_labels(spark, make):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert by_id(toxicity.judge(make([(1, "a"), (2, None)]), none), "score") == {1: 0.5, 2: 0.5}
    clean = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id bigint, quality int, toxic int")
    got = by_id(toxicity.judge(make([(i, "a b") for i in range(20)]), clean), "predicted")
    assert set(got.values()) == {0}
    assert toxicity.judge(make([]), clean).count() == 0


def test_features_do_not_depend_on_the_batch():
    texts = ["The cat, sat", "", "the CAT sat on a mat", "é x", "..."]
    joined = "".join(texts).encode()
    ends = np.cumsum([0] + [len(t.encode()) for t in texts])
    hashes, of = toxicity.features(np.frombuffer(joined, np.uint8), ends)
    for i, t in enumerate(texts):
        data = np.frombuffer(t.encode(), np.uint8)
        alone = toxicity.features(data, np.array([0, len(data)]))[0]
        assert sorted(hashes[of == i].tolist()) == sorted(alone.tolist())
    first = toxicity.features(np.frombuffer(b"the cat sat", np.uint8), np.array([0, 11]))[0]
    assert sorted(first.tolist()) == sorted(hashes[of == 0].tolist())


def plain_features(text):
    """Words, starts of words and pairs of words with 0 to 2 words between, as a set."""
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    out = set(words)
    for size in toxicity.STEMS:
        out |= {("start", w.encode()[:size], size) for w in words if len(w.encode()) > size}
    for skip in toxicity.SKIPS:
        out |= {(a, b, skip) for a, b in zip(words, words[skip + 1 :])}
    return out


def plain_model(texts, labels):
    """FTRL-proximal, one feature and one row at a time."""
    sets = [plain_features(t) for t in texts]
    held = Counter(f for s in sets for f in s)
    sets = [{f for f in s if held[f] >= toxicity.MIN_ROWS} | {None} for s in sets]
    z, n = defaultdict(float), defaultdict(float)
    l1 = toxicity.L1_PER_ROW * len(texts) * toxicity.PASSES

    def weight(f):
        if abs(z[f]) <= l1:
            return 0.0
        return (math.copysign(l1, z[f]) - z[f]) / ((toxicity.BETA + math.sqrt(n[f])) / toxicity.ALPHA + toxicity.L2)

    def chance(s):
        return 1 / (1 + math.exp(-min(max(math.fsum(weight(f) for f in s), -35), 35)))

    for _ in range(toxicity.PASSES):
        for s, label in zip(sets, labels):
            g = chance(s) - label
            for f in sorted(s, key=str):
                w = weight(f)
                z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / toxicity.ALPHA * w
                n[f] += g * g
    return lambda text: chance({f for f in plain_features(text) if held[f] >= toxicity.MIN_ROWS} | {None}), weight, held


def test_scores_equal_a_plain_ftrl_loop(make):
    docs, labels = corpus(150, 4)
    docs[3] = (3, "Été vile VILE, rotten-scoundrel x1 é")
    y = [t for _, _, t in labels]
    chance, weight, held = plain_model([t for _, t in docs], y)
    model = toxicity.fit([t for _, t in docs], np.array(y, float))
    kept = sum(1 for f in held if held[f] >= toxicity.MIN_ROWS and weight(f) != 0)
    assert len(model[0]) == kept > 5 and model[2] == pytest.approx(weight(None))
    tried = docs + [(1000 + i, t) for i, (_, t) in enumerate(corpus(60, 9)[0])] + [(2000, ""), (2001, None)]
    got = by_id(toxicity.score(make(tried), model), "score")
    for i, text in tried:
        assert got[i] == pytest.approx(chance(text or ""), abs=1e-9), i


def test_long_texts_and_labels_without_documents_do_not_shrink_the_sample(spark, make, labelled, monkeypatch):
    docs, labels, truth = labelled
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 400)
    monkeypatch.setattr(toxicity, "SAMPLE_TEXT", 2000)
    few = docs[:300] + [(i, "long " * 1000) for i, _ in docs[300:320]]
    alone = spark.createDataFrame([(100_000 + i, 1, 1) for i in range(5000)], labels.schema)
    found = toxicity.sample(make(few), labels.unionByName(alone), "doc_id", "text", "toxic")
    assert found.count() == 300
