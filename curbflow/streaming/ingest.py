"""Picking up new month files as a stream of file names.

The stream only tells which months have new files, parquet or CSV. Each of them is then
loaded from *all* its files by the idempotent bronze load, so a month that
arrives in several batches, or a batch that runs twice, ends up complete.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.session import folder as shared_folder
from curbflow.sinks import bronze
from curbflow.sources import months

FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def new_files(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of paths below ``folder``; file contents are not read."""
    return (
        spark.readStream.format("binaryFile").schema(FILES)
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{csv,parquet}")
        .load(folder).select("path")
    )


def ingest(spark: SparkSession, folder: str, table: str, checkpoint: str) -> int:
    """Load all months that got new files since the last run; returns the batches run."""
    ran: list[int] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        month = F.concat(F.regexp_extract("path", months.ENTRY, 2),
                         F.regexp_extract("path", months.ENTRY, 3))
        # one value per month
        touched = [r.m for r in batch.where(F.col("path").rlike(months.ENTRY))
                   .select(month.cast("int").alias("m")).distinct().collect()]
        if touched:
            session = batch.sparkSession
            source = months.read(session, folder).where(F.col("file_month").isin(touched))
            seen = months.inspect(session, folder, shared_folder(session, "checks", uuid.uuid4().hex[:10]))
            bronze.load(session, source, table, folder=seen, only=touched)
        ran.append(batch_id)

    query = (
        new_files(spark, folder).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return len(ran)
