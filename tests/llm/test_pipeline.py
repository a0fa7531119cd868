"""Stages of the corpus pipeline on a small corpus, and the registered queries of this subpackage."""

import random
from collections import Counter

import corpus_pipeline
import pytest
from test_substrings import PASSAGE, spread, words

from hourly_demand.llm import mixing, queries

ROWS = 240


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(ROWS):
        text = words(60 + i % 40, i)
        if i % 10 == 1:
            text = text[:20] + PASSAGE + text[20:]
        if i % 10 == 2:
            text = docs[i - 2][1].split()  # a copy in other lines
        bad = i % 4 == 3
        if bad:
            text[5:5] = ["vile", "rotten"]
        docs.append((i, spread(text, i), "en", rng.choice(["a", "b", "c"]), 0))
        labels.append((i, 1, int(bad)))
    docs += [(1000, None, "en", None, None), (1001, "", "en", "a", 0)]
    folder = tmp_path_factory.mktemp("corpus")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(docs, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), docs


def test_stages(spark, corpus, tmp_path):
    folder, docs = corpus
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = frame.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, folder).write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        kept[name] = frame.collect()
        assert name == "byte_bpe" or frame.columns == columns
    ids = {n: Counter(r["doc_id"] for r in rows) for n, rows in kept.items()}
    toxic = {i for i in range(ROWS) if i % 4 == 3}
    clean = {d[0] for d in docs} - toxic
    assert set(ids["toxicity"]) == clean
    copies = {i for i in clean if i < ROWS and i % 10 == 2 and i - 2 in clean}
    near = ids["simhash_near_dedup"]
    assert set(near) & copies == set() and clean - copies - {1000, 1001} <= set(near)
    assert max(near.values()) == 1 and len({1000, 1001} & set(near)) == 1
    assert ids["substring_dedup"] == near
    text = " ".join(PASSAGE)
    assert [r["doc_id"] for r in kept["substring_dedup"] if text in " ".join((r["text"] or "").split())] == [1]
    size, taken = Counter(), Counter()
    for r in kept["substring_dedup"]:
        size[r["source"]] += len((r["text"] or "").split())
    for r in kept["source_mix"]:
        taken[r["source"]] += len(r["text"].split())
    target = mixing.targets(dict(size), lambda i: 1 + i % 3, 3)
    assert all(abs(taken[s] - target[s]) <= 100 for s in target)
    assert max(ids["source_mix"].values()) <= 3
    assert ids["byte_bpe"] == ids["source_mix"]
    assert all(r["n_tokens"] == len(r["ids"]) for r in kept["byte_bpe"])


def test_run(spark, corpus):
    folder, _ = corpus
    once = corpus_pipeline.run(spark, folder)
    assert once.count() == corpus_pipeline.run(spark, folder).count() > 0


def test_run_on_empty_tables(spark, corpus, tmp_path):
    folder, _ = corpus
    for t in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_columns_with_names_of_their_own(spark, corpus):
    from pyspark.sql import functions as F

    folder, _ = corpus
    names = ["score", "predicted", "size", "taken", "target", "spans", "row", "fp", "clusters"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60).withColumns({c: F.concat(F.lit(c), "doc_id") for c in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == (None if r["doc_id"] is None else f"{c}{r['doc_id']}") for r in rows for c in names)


def test_each_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
