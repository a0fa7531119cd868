"""One registered query per operator, over its whole table, and the SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, lexical, lines, merkle, mixing, sharding, simhash, substrings, token_counts, topk, toxicity, url_filter
from .common import table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded bytes of every text."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, ids=False).drop("text")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a third of the keys is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.judge(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, at most 4 different bits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, shingle=4, distance=4)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest scores of every 50th vector against all others."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text; more than 2,048 tokens are over the limit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), limit=2048).drop("text")


#: The list of op6.
URL_RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).drop("url")


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors found for every 50th one."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents")
    narrow = docs.select("doc_id", "source", mixing.words(F.col("text")).alias("words"))
    return mixing.mix(narrow, F.array("source"), key=["doc_id"], size=F.col("words")).drop("source", "words")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that every document loses, as another one has them too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substrings.repeats(docs)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", substrings.row_key("doc_id", "text").alias("row"))
    joined = rows.join(found, "row", "left").drop("row")
    return joined.withColumns(
        {
            "spans": F.coalesce(F.transform("spans", lambda s: F.concat(s["start"], F.lit("-"), s["end"])), F.array().cast("array<string>")),
            "removed_words": F.coalesce("removed_words", F.lit(0).cast("bigint")),
            "clusters": F.coalesce("clusters", F.array().cast("array<bigint>")),
            "kept_in": F.coalesce("kept_in", F.array().cast("array<bigint>")),
        }
    )


#: Bytes of text in a shard.
SHARD_BYTES = 16 << 20


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    return sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARD_BYTES).drop("text")


#: Fields of a leaf, in this order.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; proofs of a fifth of them are tried on tampered texts."""
    docs = table(spark, sf_dir, "documents").select(*LEAF)
    fifth = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.prove(docs, LEAF, {"text": lines.lowered(F.col("text"))}, fifth)


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest-scoring documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, those that go as an earlier document holds them, and a digest of the rest."""
    cut = lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), shortest=10, documents=2)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_simhash": op3_simhash,
    "op4_topk": op4_topk,
    "op5_token_counts": op5_token_counts,
    "op6_url_filter": op6_url_filter,
    "op7_ann": op7_ann,
    "op8_source_mix": op8_source_mix,
    "op9_substrings": op9_substrings,
    "op10_shards": op10_shards,
    "op11_merkle": op11_merkle,
    "op12_lexical": op12_lexical,
    "op13_lines": op13_lines,
}

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
_FIELDS, _TAMPERED = (
    " || ".join(f"coalesce(strlen(({c})::VARCHAR) || ':' || ({c}), '-')" for c in (*LEAF[:-1], text)) for text in ("text", f"translate(text, {_UPPER}, {_LOWER})")
)
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE = {
    "op4_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op6_url_filter": """
        WITH u AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), p AS (
            SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
                   regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
            FROM u
        ), h AS (
            SELECT page_id, path,
                   translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
            FROM p
        ), r(action, rhost, rpath) AS (
            VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
        ), f AS (
            SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(action, length(rhost || rpath)) AS verdict
            FROM h JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
            GROUP BY page_id
        )
        SELECT h.page_id, h.host, h.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
        FROM h LEFT JOIN f USING (page_id)""",
    "op10_shards": f"""
        WITH d AS (
            SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
                   ('0x' || substr(md5(md5(coalesce(doc_id::VARCHAR, '')) || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
            FROM documents
        ), k AS (
            SELECT h, n_bytes, g.depth, h >> (60 - g.depth) AS prefix FROM d, (SELECT unnest(range(0, 31))::BIGINT AS depth) g
        ), n AS (
            SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes FROM k GROUP BY ALL
        ), s AS (
            SELECT d.doc_id, d.n_bytes, d.h, min_by(n.depth, n.depth) AS depth, min_by(n.shard_bytes, n.depth) AS shard_bytes
            FROM d JOIN n ON n.prefix = d.h >> (60 - n.depth)::BIGINT
            WHERE n.shard_bytes <= {SHARD_BYTES} GROUP BY ALL
        )
        SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE right(bin(h + (1::BIGINT << 60)), 60)[1:depth] END AS shard,
               depth::INTEGER AS depth, shard_bytes, TRUE AS fits
        FROM s""",
    "op11_merkle": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, sha256({_FIELDS}) AS leaf, sha256({_TAMPERED}) AS changed,
                   list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                       lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))) AS crc
            FROM documents
        ), start AS (
            SELECT doc_id, coalesce('s' || source, '') AS grp, leaf, CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN changed ELSE leaf END AS tried,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
            FROM d
        ), low(grp, level, pos, h, n) AS (
            SELECT grp, 0, pos, leaf, count(*) OVER (PARTITION BY grp) FROM start
            UNION ALL
            SELECT grp, level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
            FROM low WHERE n > 1 GROUP BY grp, level, pos // 16
        ), tops AS (
            SELECT grp, h AS subroot, level AS height, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS groups FROM low WHERE n = 1
        ), high(level, pos, h, n) AS (
            SELECT 0, place, subroot, groups FROM tops
            UNION ALL
            SELECT level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
            FROM high WHERE n > 1 GROUP BY level, pos // 16
        ), siblings AS (
            SELECT *, coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM (SELECT grp, level, pos, h FROM low WHERE n > 1 UNION ALL SELECT NULL, level, pos, h FROM high WHERE n > 1)
            WINDOW run AS (PARTITION BY grp, level, pos // 16 ORDER BY pos)
        ), climb(doc_id, grp, own, level, pos, place, height, proof, h) AS (
            SELECT doc_id, grp, start.pos, 0, start.pos, place, height, '', tried FROM start JOIN tops USING (grp)
            UNION ALL
            SELECT c.doc_id, c.grp, c.own, c.level + 1, CASE WHEN c.level + 1 = height THEN place ELSE c.pos // 16 END, place, height,
                   proof || s.l || s.r, sha256(s.l || c.h || s.r)
            FROM (SELECT *, CASE WHEN level < height THEN grp END AS g, CASE WHEN level < height THEN level ELSE level - height END AS k,
                         CASE WHEN level = height THEN place ELSE pos END AS at FROM climb) c
            JOIN siblings s ON s.grp IS NOT DISTINCT FROM c.g AND s.level = c.k AND s.pos = c.at
        ), done AS (
            SELECT grp, own, max_by(proof, level) AS proof, max_by(h, level) AS folded_root FROM climb GROUP BY grp, own
        )
        SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, folded_root, folded_root = root.h AS verified
        FROM start JOIN tops USING (grp) JOIN done ON done.grp = start.grp AND done.own = start.pos, (SELECT h FROM high WHERE n = 1) root""",
    "op12_lexical": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, {_UPPER}, {_LOWER}), '{_TERM}') AS terms FROM documents
        ), tf AS (
            SELECT r, doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, unnest(terms) AS term FROM d) GROUP BY ALL
        ), n AS (
            SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r
        ), s AS (
            SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n
        ), w AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY term, docs
        ), q AS (
            SELECT item_id, term, count(*) AS times
            FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, {_UPPER}, {_LOWER}), '{_TERM}')) AS term FROM benchmark) GROUP BY ALL
        ), scored AS (
            SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
            FROM q JOIN w USING (term) JOIN tf USING (term) JOIN n USING (r), s GROUP BY ALL
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_lines": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), l AS (
            SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d
        ), k AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_UPPER}, {_LOWER}) AS key FROM l
        ), f AS (
            SELECT key, min(doc_id) AS low FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
        ), m AS (
            SELECT k.*, f.key IS NOT NULL AND doc_id <> low AS gone FROM k LEFT JOIN f USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY r, doc_id""",
}
