"""op1 against tiktoken, op5 against tokenizers."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers

from hourly_demand.llm import bpe, token_counts

TEXTS = [
    None, "", " ", "a", "Hello world, it's   DON'T\n\n\tdone ", "ß é é 你好 😀 ½①", "x" * 5000, "ab" * 400 + " 'll",
    " " * 300 + "y", "'" * 700, "1" * 600, "İΣσς ǅ 　 \x85\x1c", "<|endoftext|> a<|startoftext|>b", "x" * 511 + "'re", "x" * 512 + " y",
]


def random_texts(n, seed):
    rng = random.Random(seed)
    parts = ["'s", "'re", "'r", "'l", "''", " the", "ing", "tion", "Th", "é", "你", " ", "\n", "1", "!?", "á", "’", "Ж", "́", "x"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_decoding(make, ranks, reference):
    texts = TEXTS + random_texts(200, 1)
    docs = make(list(enumerate(texts)) + [(0, "again")], extra="ids")
    rows = bpe.encode(docs, ranks, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        text = r["text"] or ""
        want = reference.encode_ordinary(text)
        assert r["ids"] == want and r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, dtype="<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_fold_equals_merges(spark, ranks, reference):
    words = [w for t in random_texts(60, 2) for w in bpe.regex.findall(public_tokenizers.PATTERN, t) if len(w.encode()) <= 32]
    words = sorted(set(words) | {"", "a", " the", " tokenization", "zzzzzzzz"})
    vocabulary, merger = bpe.Vocabulary(ranks), bpe.Merger(ranks)
    rows = bpe.encode_words(spark.createDataFrame([(w,) for w in words], "w string"), vocabulary).collect()
    for r in rows:
        assert r["ids"] == (merger.ids(r["w"].encode()) if r["w"] else []) == reference.encode_ordinary(r["w"])


def test_long_words_by_heap(ranks):
    merger, rng = bpe.Merger(ranks), random.Random(3)
    for n in (1, 2, 50, 300):
        word = bytes(rng.choice(b"abcde th") for _ in range(n))
        assert merger._by_heap(word) == merger._by_scan(word)
    assert merger._by_heap(b"a" * 257) == merger._by_scan(b"a" * 257)


def test_decode_column(spark, ranks):
    from pyspark.sql import functions as F

    hexes = ["61", "e9", "2062"]
    df = spark.createDataFrame([([0, 2, 1],), ([],)], "ids array<int>")
    got = df.select(bpe.decode_ids(F.col("ids"), F.array(*[F.lit(h) for h in hexes])).alias("b")).collect()
    assert [bytes(r["b"]) for r in got] == [b"a b\xe9", b""]


def test_empty_table(make, ranks):
    assert bpe.encode(make([]), ranks, public_tokenizers.PATTERN).count() == 0
    assert token_counts.count_tokens(make([]), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_counts(make):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = TEXTS + random_texts(500, 4) + ["word " * 3000, "z" * 2000 + " " + "q" * 2000]
    docs = make(list(enumerate(texts)), extra="n_tokens")
    known = tokenizers.Tokenizer.from_file(path)
    for r in token_counts.count_tokens(docs, path, limit=100).collect():
        text = r["text"] or ""
        want = len(known.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), want, want > 100), text[:50]


def test_counts_do_not_depend_on_chunks(monkeypatch):
    compiled = token_counts.Tokenizer(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    texts = [t or "" for t in TEXTS] + random_texts(100, 5)
    want = compiled.count(texts).tolist()
    for size in (3, 17):
        monkeypatch.setattr(token_counts, "CHUNK", size)
        assert compiled.count(texts).tolist() == want
    monkeypatch.setattr(token_counts, "TABLE_BYTES", 0)  # the table begins anew each time
    assert compiled.count(texts).tolist() == want


def test_other_tokenizers_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        token_counts.Tokenizer(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())


def test_frequent_words(make):
    docs = make([(1, "a b a"), (2, "a c"), (3, None)])
    got = [r["w"] for r in bpe.frequent_words(docs, "text", public_tokenizers.PATTERN, 1).collect()]
    assert got == ["a"] or Counter(got) == Counter([" a"])
