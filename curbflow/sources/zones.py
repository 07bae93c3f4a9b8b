"""The zone dimension: a lookup CSV with one row per location id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LOOKUP_SCHEMA = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"
MISSING = "N/A"


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Four renamed columns; empty strings become 'N/A', as real rows spell it."""
    return (
        spark.read.schema(LOOKUP_SCHEMA).csv(path, header=True)
        .withColumnsRenamed({"LocationID": "location_id", "Borough": "borough", "Zone": "zone"})
        .fillna(MISSING, ["borough", "zone", "service_zone"])
    )


def write_lookup(zones: DataFrame, path: str) -> None:
    zones.selectExpr(
        "location_id AS LocationID", "borough AS Borough", "zone AS Zone", "service_zone"
    ).write.mode("overwrite").csv(path, header=True, quoteAll=True)


def replace(zones: DataFrame, path: str) -> None:
    """Full replacement of the stored dimension (a few hundred rows, one file)."""
    zones.coalesce(1).write.mode("overwrite").parquet(path)
