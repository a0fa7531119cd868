"""A training corpus from raw documents: each stage works on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourly_demand.llm import bpe, mixing, simhash, substrings, toxicity
from hourly_demand.llm.common import stored, table


def _beside(docs: DataFrame, names: tuple[str, ...], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """work(docs), with columns of docs that have one of its own names kept aside."""
    aside = {c: f"_own_{c}" for c in docs.columns if c in names}
    out = work(docs.withColumnsRenamed(aside)).drop(*aside)
    return out.withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic, by the labels that are not held out."""
    labels = table(spark, sf_dir, "labels")
    return _beside(docs, ("held_out", "score", "predicted"), lambda d: toxicity.judge(d, labels).where("predicted = 0"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 4-word shingles, at most 4 different bits."""
    return simhash.one_of_each(docs, shingle=4, distance=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words and more that another document keeps."""

    def cut(d: DataFrame) -> DataFrame:
        out = substrings.dedup(d)
        if "n_chars" not in d.columns:
            return out
        length = F.length("text").cast(d.schema["n_chars"].dataType)
        return out.withColumn("n_chars", F.when(F.col("spans").isNull(), F.col("n_chars")).otherwise(length))

    return _beside(docs, ("spans", "removed_words", "clusters", "kept_in"), cut)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; sources weigh 1, 2, 3, repeating."""
    uses = F.when(F.col("taken") > 0, F.expr("taken div size")).otherwise(0).cast("int")

    def taken(d: DataFrame) -> DataFrame:
        mixed = mixing.mix(d, F.array("source"), key=["doc_id"])
        return mixed.where("taken > 0").withColumn("_use", F.explode(F.sequence(F.lit(1), uses)))

    return _beside(docs, ("size", "source_size", "target", "taken", "_use"), taken)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

#: SQL cannot express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        # Written as Parquet in the shared folder and read again as the next stage's documents.
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
