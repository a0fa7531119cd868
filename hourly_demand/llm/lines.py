"""Line dedup with DataFrame functions only.

1. Every text is split at line feeds and its lines are exploded. A line's key is the line without
   blanks at both ends and with A-Z lower-cased; keys of fewer than `shortest` code points stay out.
   Of a key only 128 bits travel: two XXH64 with different seeds.
2. Per hash, the smallest and largest document are taken, with map-side combining. A hash is found in
   at least `documents` different ones if these differ (for 2), or else by an exact distinct count.
   The smallest document is the one that keeps its lines.
3. The exploded hashes are joined with those found too often. It is a plain equi-join without an
   aggregate on its key, so a line that a third of all documents hold is split by adaptive execution.
   What is to drop is gathered as line numbers per document, never more than the document has lines.
4. Texts are put together again from the runs of lines between the dropped ones, by position.

A document is a doc_id: rows of one doc_id do not count twice, and all of them keep their lines if
theirs is the smallest doc_id. A null doc_id is one document, larger than all others. A null or empty
text is one empty line; its kept text is empty. Empty tables give no rows, repeated rows stay. Extra
columns stay; columns named n_lines, n_dropped or kept are replaced.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored

#: White space that is stripped.
BLANKS = " \t\n\x0b\x0c\r"
ADDED = ("n_lines", "n_dropped", "kept")


def lowered(text: Column) -> Column:
    """A-Z in lower case; all other letters as they are."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def keyed_lines(rows: DataFrame, text: str, shortest: int) -> DataFrame:
    """The columns of rows but the text, the number of each line (from 0), and its hash (h1, h2)."""
    others = [F.col(c) for c in rows.columns if c != text]
    lines = F.posexplode(F.split(lowered(F.coalesce(text, F.lit(""))), "\n", -1)).alias("_line", "_key")
    keys = rows.select(*others, lines).withColumn("_key", F.btrim("_key", F.lit(BLANKS)))
    hashes = {"_h1": F.xxhash64("_key"), "_h2": F.xxhash64(F.lit(1), F.col("_key"))}
    return keys.where(F.length("_key") >= shortest).withColumns(hashes).drop("_key")


def frequent(keys: DataFrame, key: str, documents: int) -> DataFrame:
    """_h1, _h2 and the smallest document _low of the hashes in at least so many documents."""
    by = ["_h1", "_h2"]
    counted = keys
    if documents > 2:
        # Documents of a hash, each once; the counts combine on the map side.
        counted = keys.select(*by, key).distinct()
    found = counted.groupBy(*by).agg(
        F.min(key).alias("_low"),
        F.max(key).alias("_high"),
        F.max(F.col(key).isNull().cast("int")).alias("_none"),
        F.count(F.lit(1)).alias("_n"),
    )
    several = F.coalesce(F.col("_low") != F.col("_high"), F.lit(False)) | (F.col("_low").isNotNull() & (F.col("_none") == 1))
    often = {1: F.lit(True), 2: several}.get(documents, F.col("_n") >= documents)
    return found.where(often).select(*by, "_low")


def dropped_lines(docs: DataFrame, key: str, text: str, shortest: int, documents: int) -> DataFrame:
    """_id, _text (hash) and _drop, the ascending numbers of the lines that go, of the rows that lose some."""
    rows = docs.select(F.col(key).alias("_id"), F.xxhash64(text).alias("_text"), F.col(text))
    keys = keyed_lines(rows, text, shortest)
    # Stored: the join below then has a plain exchange on both sides, so a hot line can be split.
    found = stored(frequent(keys, "_id", documents), "frequent-lines")
    hit = keys.join(found, ["_h1", "_h2"]).where(~F.col("_id").eqNullSafe(F.col("_low")))
    # Equal rows lose the same lines: a set, so copies of a row do not add up.
    return hit.groupBy("_id", "_text").agg(F.sort_array(F.collect_set("_line")).alias("_drop"))


def _joined(lines: Column, drop: Column) -> Column:
    """Lines without those numbered in drop: the runs between them, each cut out once."""
    ends = F.concat(F.array(F.lit(-1)), drop, F.array(F.size(lines)))

    def runs(at: Column) -> Column:
        each = F.sequence(F.lit(1), F.size(at) - 1)
        cut = lambda i: F.slice(lines, F.get(at, i - 1) + 2, F.get(at, i) - F.get(at, i - 1) - 1)
        return F.array_join(F.flatten(F.transform(each, cut)), "\n")

    return let(ends, runs)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 10, documents: int = 2) -> DataFrame:
    """docs with n_lines (before dropping), n_dropped and kept, the text that stays."""
    plain = docs.drop(*[c for c in ADDED if c not in (key, text)])
    drops = dropped_lines(plain, key, text, shortest, documents)
    same = F.col(key).eqNullSafe(F.col("_id")) & F.xxhash64(text).eqNullSafe(F.col("_text"))
    whole = F.coalesce(F.col(text), F.lit(""))
    kept = F.when(F.col("_drop").isNull(), whole).otherwise(let(F.split(whole, "\n", -1), lambda lines: _joined(lines, F.col("_drop"))))
    return plain.join(drops, same, "left").select(
        *plain.columns,
        (F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("bigint").alias("n_dropped"),
        kept.alias("kept"),
    )
