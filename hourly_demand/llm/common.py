"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_folder


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once: inside lambdas Spark repeats an expression wherever it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders of stored tables, and of tables made from them.
_FOLDERS: WeakKeyDictionary[DataFrame, list[str]] = WeakKeyDictionary()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it has ended, not when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    with _shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = [path]
    return out


def owning(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """df, made from stored tables that go when it is spent."""
    _FOLDERS[df] = [f for t in tables for f in _FOLDERS.get(t, [])]
    return df


def spent(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more, as what was made from them is stored."""
    for table in tables:
        jvm, spark = table.sparkSession._jvm, table.sparkSession
        for folder in _FOLDERS.pop(table, []):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most so many bytes of text; a longer text alone."""
    if not batch.num_rows:
        return
    ends = text_bytes(batch.column(column))[1]
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[start] + most, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of UTF-8 bytes, and the n + 1 offsets of the texts in it; null is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch without columns of these names, then the new ones."""
    kept = [k for k in batch.schema.names if k not in new]
    return pa.RecordBatch.from_arrays([batch.column(k) for k in kept] + list(new.values()), names=kept + list(new))
