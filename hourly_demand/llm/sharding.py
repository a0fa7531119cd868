"""Shards of bounded size by extendible hashing, with DataFrame functions only.

Rows are placed by the leading bits of a hash. The directory starts as one bucket; a bucket whose
rows take more bytes than the limit splits on one more bit, and only such a bucket does, until
every one fits. So shards have prefixes of different length, and adding rows splits only the
buckets that overflow.

All splits come from one histogram: bytes are summed by a prefix fine enough that a bucket holds
about 1/64 of the limit, each sum is passed up to all shorter prefixes, and a shard is the shortest
prefix that fits. Buckets that are still too large, which takes a very long row or many rows of
equal hash, go through another round on their next bits. The histogram has 64 to 128 rows per
shard; it is joined to the rows by prefix, so neither hot keys nor long texts meet in one task.

Rows whose whole hash is equal are copies of one row. Copies that together exceed the limit are
dealt out in runs that fit, within the part of the input they were read from. A single row longer
than the limit is a shard of its own with `fits` false.

Null keys and texts count as empty. Empty tables give no rows. Columns named n_bytes, shard, depth,
shard_bytes or fits are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

HASH_BITS = 60
#: Bits beyond log2(total / limit) of the first histogram, and bits added by each further round.
SPARE_BITS = 6
ADDED = ("n_bytes", "shard", "depth", "shard_bytes", "fits")


def row_hash(columns: Sequence[Column]) -> Column:
    """60 bits of the MD5 of the columns, each a text by its own MD5; null is empty."""
    parts = [F.md5(F.coalesce(c.cast("string"), F.lit(""))) for c in columns]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _prefix(bits: int) -> Column:
    return F.shiftright("_hash", HASH_BITS - bits)


def _directory(rows: DataFrame, fine: int, coarse: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(fine prefix -> shard, fine prefixes that are still too large) for shards of coarse to fine bits."""
    sums = rows.groupBy(_prefix(fine).alias("_fine")).agg(F.sum("n_bytes").alias("bytes"))
    up = sums.withColumn("depth", F.explode(F.sequence(F.lit(coarse), F.lit(fine)))).withColumn(
        "_prefix", F.expr(f"shiftright(_fine, {fine} - depth)")
    )
    nodes = up.groupBy("depth", "_prefix").agg(F.sum("bytes").alias("shard_bytes"))
    fitting = nodes.where(F.col("shard_bytes") <= limit)
    # The shortest of the prefixes of a fine one that fit.
    shards = (
        up.join(fitting, ["depth", "_prefix"])
        .groupBy("_fine")
        .agg(F.min(F.struct("depth", "_prefix", "shard_bytes")).alias("s"))
        .select("_fine", "s.depth", "s._prefix", "s.shard_bytes")
    )
    return shards, sums.where(F.col("bytes") > limit).select("_fine")


def assign(docs: DataFrame, limit: int, key: Sequence[str] = ("doc_id", "text"), text: str = "text") -> DataFrame:
    """docs with n_bytes, shard (its prefix as a text of bits), depth, shard_bytes and fits."""
    if limit < 1:
        raise ValueError("the limit has to be positive")
    plain = docs.drop(*[c for c in ADDED if c != text])
    rows = plain.withColumns(
        {"_hash": row_hash([F.col(c) for c in key]), "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")}
    )
    total = rows.agg(F.sum("n_bytes").alias("n")).first()["n"] or 0
    fine = min(HASH_BITS, max(0, math.ceil(math.log2(max(total / limit, 1)))) + SPARE_BITS)
    out, coarse = None, 0
    while True:
        shards, large = _directory(rows, fine, coarse, limit)
        placed = (
            rows.withColumn("_fine", _prefix(fine))
            .join(shards, "_fine")
            .withColumn("shard", F.expr("if(depth = 0, '', lpad(bin(_prefix), depth, '0'))"))
            .withColumn("fits", F.lit(True))
            .drop("_hash", "_fine", "_prefix")
        )
        out = placed if out is None else out.unionByName(placed)
        large = stored(large, "large-buckets")
        if large.isEmpty():
            return out
        rows = rows.withColumn("_fine", _prefix(fine)).join(large, "_fine", "left_semi").drop("_fine")
        if fine == HASH_BITS:
            return out.unionByName(_copies(rows, limit))
        coarse, fine = fine + 1, min(HASH_BITS, fine + 16)


def _copies(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of equal hash that exceed the limit together: runs that fit, per part of the input."""
    # Written, so that the part of a row is the same whenever it is read.
    fixed = stored(rows.withColumn("_part", F.spark_partition_id()), "copies")
    of = Window.partitionBy("_hash", "_part")
    run = F.when(F.col("n_bytes") > 0, F.greatest(F.lit(1), F.expr(f"cast({limit} div n_bytes as int)"))).otherwise(1 << 30)
    number = F.floor((F.row_number().over(of.orderBy("n_bytes")) - 1) / run)
    name = F.concat(F.lpad(F.bin("_hash"), HASH_BITS, "0"), F.lit("-"), F.col("_part"), F.lit("-"), F.col("_run"))
    numbered = fixed.withColumn("_run", number)
    shard = Window.partitionBy("_hash", "_part", "_run")
    return numbered.withColumns(
        {
            "depth": F.lit(HASH_BITS),
            "shard_bytes": F.sum("n_bytes").over(shard),
            "shard": name,
            "fits": F.sum("n_bytes").over(shard) <= limit,
        }
    ).drop("_hash", "_part", "_run")


def write(docs: DataFrame, path: str, limit: int, **options) -> None:
    """Writes every shard as one Parquet folder below path, shard=<bits>; the shard of no bits is `all`."""
    named = assign(docs, limit, **options).drop("n_bytes", "depth", "shard_bytes", "fits")
    named = named.withColumn("shard", F.when(F.col("shard") == "", "all").otherwise(F.col("shard")))
    named.repartition("shard").write.partitionBy("shard").parquet(path)
