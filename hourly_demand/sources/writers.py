"""Writers. Spark's commit protocol makes each write appear only when it is complete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TS


def write_panel(df: DataFrame, path: str, ts: str = TS, keys: Sequence[str] = (), buckets: int = 8) -> None:
    """Panel as Parquet by month; only the months in `df` are replaced.

    Rows are gathered by month, day and, with `keys`, one of `buckets` parts of the series, so a
    month becomes a limited number of files and a day of very many series more than one task.
    """
    out = df.withColumn("month", F.date_format(ts, "yyyy-MM"))
    part = [F.pmod(F.xxhash64(*keys), F.lit(buckets))] if keys else []
    (
        out.repartition("month", F.to_date(ts), *part)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(path)
    )


def write_table(df: DataFrame, path: str, fmt: str = "csv", partition_by: Sequence[str] = ()) -> None:
    """Result table as CSV with a header, or as Parquet."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError("fmt must be 'csv' or 'parquet'")


def write_json(df: DataFrame, path: str, keep_nulls: bool = True) -> None:
    """Records as JSON lines; nested arrays and structs are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", not keep_nulls).json(path)


def as_json(df: DataFrame, name: str = "record") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name))


def nested_columns(df: DataFrame) -> list[str]:
    """Columns a CSV cannot hold."""
    return [f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
