"""Readers of trips, zones and series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TS, Y

# Source columns of the trip files.
TRIP_MAPPING = {
    "pickup_datetime": "tpep_pickup_datetime",
    "zone_id": "PULocationID",
    "trip_distance": "trip_distance",
    "total_amount": "total_amount",
}
TRIP_TYPES = {
    "pickup_datetime": "timestamp_ntz",
    "zone_id": "bigint",
    "trip_distance": "double",
    "total_amount": "double",
}
# The five city boroughs.
BOROUGHS = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island")
# A path part that ends in a month: trips_2024-01.parquet, month=2024-01, 2024-01.
MONTH_IN_PATH = r"[_=/](\d{4}-\d{2})(?:\.parquet)?(?:/|$)"


def project_trips(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """The four trip columns, typed; raises when a source column is missing.

    `mapping` gives a source column for each trip column. Values that cannot be parsed become
    NULL and are rejected by the cleaning rules.
    """
    mapping = {**TRIP_MAPPING, **(mapping or {})}
    missing = sorted(set(mapping.values()) - set(df.columns))
    if missing:
        raise ValueError(f"missing trip columns: {missing}")
    month = [F.col("file_month")] if "file_month" in df.columns else []
    cols = [F.col(mapping[c]).try_cast(t).alias(c) for c, t in TRIP_TYPES.items()]
    return df.select(*cols, *month)


def month_of_path(path: str) -> Column:
    """First day of the month a path names, or NULL."""
    return F.concat(F.regexp_extract(path, MONTH_IN_PATH, 1), F.lit("-01")).try_cast("date")


def _with_file_month(df: DataFrame) -> DataFrame:
    return df.withColumn("file_month", month_of_path("_metadata.file_path"))


def read_trips(
    spark: SparkSession, *paths: str, mapping: dict[str, str] | None = None, month_from_name: bool = False
) -> DataFrame:
    """Projected scan of trip files. With `month_from_name`, adds the month in each file's name."""
    df = spark.read.parquet(*paths)
    return project_trips(_with_file_month(df) if month_from_name else df, mapping)


def read_months(
    spark: SparkSession, paths: Sequence[str], mapping: dict[str, str] | None = None, drift: bool = False
) -> DataFrame:
    """Trips of several monthly files with their file month.

    One scan reads all files. Set `drift` when column types differ between files: each path is
    then read with its own schema, typed and appended.
    """
    if not drift:
        return read_trips(spark, *paths, mapping=mapping, month_from_name=True)
    parts = [read_trips(spark, p, mapping=mapping, month_from_name=True) for p in paths]
    return union_all(parts)


def read_stale_months(spark: SparkSession, folder: str, months: Sequence, mapping: dict[str, str] | None = None) -> DataFrame:
    """Trips of some months below a folder, with their file month.

    The months are a filter on the path of each file. It reaches the scan, which drops all other
    files before it opens them, so no list of paths is made. The schema is that of one of their files.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    one = listed.filter(month_of_path("path").isin(list(months))).agg(F.min("path").alias("path")).first()["path"]
    schema = spark.read.parquet(one).schema
    every = _with_file_month(spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder))
    return project_trips(every.filter(month_of_path("_metadata.file_path").isin(list(months))), mapping)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Appends frames by column name."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def zones(spark: SparkSession, path: str, boroughs: Sequence[str] = BOROUGHS) -> DataFrame:
    """Zone ids of the wanted boroughs from a CSV with LocationID and Borough."""
    raw = spark.read.option("header", True).csv(path)
    missing = sorted({"LocationID", "Borough"} - set(raw.columns))
    if missing:
        raise ValueError(f"missing zone columns: {missing}")
    table = raw.select(F.col("LocationID").try_cast("bigint").alias("zone_id"), F.col("Borough").alias("borough"))
    return select_zones(table, boroughs)


def select_zones(table: DataFrame, boroughs: Sequence[str] = BOROUGHS) -> DataFrame:
    return table.filter(F.col("borough").isin(*boroughs) & F.col("zone_id").isNotNull()).select("zone_id").distinct()


def read_series_csv(spark: SparkSession, path: str, keys: dict[str, str] | None = None) -> DataFrame:
    """Uploaded history; a row that cannot be parsed fails the read. `keys` maps key columns to types."""
    fields = [f"{k} {t}" for k, t in (keys or {}).items()]
    schema = ", ".join([*fields, f"{TS} TIMESTAMP_NTZ", f"{Y} DOUBLE"])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("timestampNTZFormat", "yyyy-MM-dd[ ]['T']HH:mm[:ss][.SSS]")
        .csv(path)
    )
