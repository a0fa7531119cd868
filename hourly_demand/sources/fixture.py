"""The driver's tables seen as trips and zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Rules
from .readers import project_trips

RULES = Rules(start="2024-01-02", end="2024-01-30", max_distance=100.0, max_amount=90.0)
BOROUGHS = ("AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_trips(events: DataFrame) -> DataFrame:
    amount = F.get_json_object("props", "$.k")
    mapping = {
        "pickup_datetime": "ts",
        "zone_id": "user_id",
        "trip_distance": "value",
        "total_amount": "amount",
    }
    return project_trips(events.withColumn("amount", amount), mapping)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_trips(table(spark, sf_dir, "events"))


def zone_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as zones, their region as borough."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(F.col("c_custkey").alias("zone_id"), F.col("r_name").alias("borough"))
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .readers import select_zones

    return select_zones(zone_table(spark, sf_dir), BOROUGHS)
