"""Service tables: the load log, and tables whose rows are replaced by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_log(entries: DataFrame, path: str) -> None:
    """Append load results, one row per month file and run, with the time of logging."""
    entries.withColumn("loaded_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)


def log_entries(loaded: DataFrame) -> DataFrame:
    """Log rows from the result of a bronze load; durations as measured for each month."""
    month = F.col("file_month").cast("string")
    return loaded.select(
        F.concat(F.lit("fhvhv_tripdata_"), month.substr(1, 4), F.lit("-"), month.substr(5, 2),
                 F.lit(".parquet")).alias("file_name"),
        month.alias("partition_id"), F.col("rows").alias("rows_loaded"),
        F.round("seconds", 1).alias("load_duration_sec"), "status",
        F.when(F.col("status") == "skipped", "already complete")
        .otherwise(F.concat(F.lit("rows before: "), F.col("existing").cast("string"))).alias("message"),
    )


def replace_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` without the rows whose keys ``new`` brings, plus ``new``."""
    kept = old.join(new.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(new)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
