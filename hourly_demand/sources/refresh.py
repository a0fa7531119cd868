"""Incremental store of monthly counts.

`counts` holds the verdict cube of each file month, `manifest` one row per month that says from
which files and rules it was made. A month is recomputed unless its manifest row matches the rules,
the files, and the stored counts themselves. Counts are written before the manifest, so a lost run
leaves months that do not match and are simply made again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TS, Rules
from ..operators.cleaning import audit, verdict_cube
from .readers import month_of_path, read_stale_months
from .shared import delete_folder

STORE_VERSION = 1
COUNTS_SCHEMA = f"zone_id BIGINT, {TS} TIMESTAMP_NTZ, verdict STRING, n BIGINT, file_month DATE"
MANIFEST_SCHEMA = (
    "signature STRING, fingerprint STRING, raw_rows BIGINT, rejected_date BIGINT, rejected_values BIGINT, "
    "rejected_zone BIGINT, kept_rows BIGINT, checksum STRING, file_month DATE"
)


def content_checksum(cols: Sequence[str]) -> Column:
    """Checksum of the rows of a group that does not depend on their order."""
    h = F.xxhash64(*cols)
    return F.concat_ws(
        "-", F.count("*").cast("string"), F.sum(h.cast("decimal(38,0)")).cast("string"), F.bit_xor(h).cast("string")
    )


def rules_signature(rules: Rules, zones: DataFrame) -> str:
    """SHA-256 of everything the counts depend on: period, time zone, value limits and the zone set."""
    known = F.struct(
        F.lit(STORE_VERSION).alias("store"),
        *[F.lit(str(v)).alias(k) for k, v in vars(rules).items()],
        content_checksum(["zone_id"]).alias("zone_set"),
    )
    return zones.select("zone_id").distinct().agg(F.sha2(F.to_json(known), 256).alias("s")).first()["s"]


def input_months(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """Files per month with a fingerprint of their names, sizes and times, or of their content.

    A file whose name holds no month is an error: its trips would be lost without a word.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    mark = F.sha2("content", 256) if content else F.concat_ws("|", "path", "length", F.unix_micros("modificationTime"))
    return (
        files.select(month_of_path("path").alias("file_month"), mark.alias("mark"), "path")
        .withColumn("file_month", F.coalesce("file_month", F.raise_error(F.concat(F.lit("no month in the file name "), "path")).cast("date")))
        .groupBy("file_month")
        .agg(content_checksum(["mark"]).alias("fingerprint"))
    )


def stale_months(inputs: DataFrame, manifest: DataFrame, signature: str | None = None) -> DataFrame:
    """Input months without a manifest row of the same rules and files."""
    if signature is not None:
        inputs = inputs.withColumn("signature", F.lit(signature))
    return inputs.join(manifest, ["file_month", "signature", "fingerprint"], "left_anti")


def check_manifest(manifest: DataFrame, counts: DataFrame, by: str = "file_month") -> DataFrame:
    """Months with the three invariants: kept rows add up, no doubled hour, raw = kept + rejects."""
    per_hour = counts.groupBy(by, "zone_id", TS).agg(F.count("*").alias("_rows"), F.sum("n").alias("_n"))
    stored = per_hour.groupBy(by).agg(
        F.sum("_n").cast("bigint").alias("stored_rows"), F.sum(F.col("_rows") - 1).cast("bigint").alias("doubled")
    )
    parts = F.col("kept_rows") + F.col("rejected_date") + F.col("rejected_values") + F.col("rejected_zone")
    return manifest.join(stored, by, "left").select(
        by,
        (F.coalesce("stored_rows", F.lit(0)) == F.col("kept_rows")).alias("kept_ok"),
        (F.coalesce("doubled", F.lit(0)) == 0).alias("hours_ok"),
        (F.col("raw_rows") == parts).alias("raw_ok"),
    )


class Store:
    """Counts and manifest under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.counts_path = f"{path.rstrip('/')}/counts"
        self.manifest_path = f"{path.rstrip('/')}/manifest"

    def _read(self, path: str, schema: str) -> DataFrame:
        """The table, or an empty one before the first run."""
        try:
            return self.spark.read.schema(schema).parquet(path)
        except Exception as error:  # the path does not exist yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    def counts(self) -> DataFrame:
        return self._read(self.counts_path, COUNTS_SCHEMA)

    def manifest(self) -> DataFrame:
        return self._read(self.manifest_path, MANIFEST_SCHEMA)

    def valid_manifest(self) -> DataFrame:
        """Manifest rows that agree with the stored counts."""
        counts = self.counts()
        kept = counts.filter(F.col("verdict") == "kept")
        sound = check_manifest(self.manifest(), kept).filter("kept_ok AND hours_ok AND raw_ok").select("file_month")
        marks = counts.groupBy("file_month").agg(content_checksum([TS, "zone_id", "verdict", "n"]).alias("checksum"))
        return self.manifest().join(marks, ["file_month", "checksum"], "left_semi").join(sound, "file_month", "left_semi")

    def months_without(self, inputs: DataFrame) -> list:
        """Stored months that have no input any more."""
        stored = self.manifest().select("file_month").unionByName(self.counts().select("file_month")).distinct()
        return sorted(r["file_month"] for r in stored.join(inputs, "file_month", "left_anti").collect())

    def drop_months(self, months: Sequence) -> None:
        """Removes months, their manifest rows first: counts without a row are not trusted."""
        for folder in (self.manifest_path, self.counts_path):
            for month in months:
                delete_folder(self.spark, f"{folder}/file_month={month}")

    def _write(self, df: DataFrame, path: str) -> None:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("file_month")
            .parquet(path)
        )


def refresh(
    spark: SparkSession,
    src: str,
    store_path: str,
    zones: DataFrame,
    rules: Rules,
    mapping: dict[str, str] | None = None,
    content: bool = False,
) -> list:
    """Recomputes the stale months of `src` and returns them; months without files leave the store.

    Each month is rebuilt from all of its files. The only thing collected is the list of months.
    """
    store = Store(spark, store_path)
    signature = rules_signature(rules, zones)
    inputs = input_months(spark, src, content)
    stale = stale_months(inputs, store.valid_manifest(), signature).select("file_month", "signature", "fingerprint")
    todo = {r["file_month"]: (r["signature"], r["fingerprint"]) for r in stale.collect()}
    store.drop_months(store.months_without(inputs))
    if not todo:
        return []
    trips = read_stale_months(spark, src, list(todo), mapping)
    cube = verdict_cube(trips, zones, rules)
    # One month is spread over several tasks by hour; a hot month is not a hot task.
    store._write(cube.repartition("file_month", F.to_date(TS)), store.counts_path)
    made = F.create_map(*[x for m, v in todo.items() for x in (F.lit(m), F.struct(F.lit(v[0]).alias("s"), F.lit(v[1]).alias("f")))])
    counts = store.counts().filter(F.col("file_month").isin(list(todo)))
    marks = counts.groupBy("file_month").agg(content_checksum([TS, "zone_id", "verdict", "n"]).alias("checksum"))
    rows = audit(counts, ["file_month"]).join(marks, "file_month").withColumns(
        {"signature": made[F.col("file_month")]["s"], "fingerprint": made[F.col("file_month")]["f"]}
    )
    names = [part.strip().split(" ")[0] for part in MANIFEST_SCHEMA.split(",")]
    store._write(rows.select(*names), store.manifest_path)
    return sorted(todo)
