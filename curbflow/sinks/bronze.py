"""The bronze table: a snapshot of parquet by pickup month, sorted by pickup zone and time."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.contract import PARTITION, month_key, to_bronze
from curbflow.operators import contract_checks, profile
from curbflow.session import folder as work_folder
from curbflow.sinks import snapshots
from curbflow.sources import footers, months

c = F.col


#: Rows of a bronze file at most.
FILE_ROWS = 4_000_000


def write_months(
    trips: DataFrame, path: str, *, rebuild: bool = False, scattered: bool = False, file_rows: int = FILE_ROWS,
    made: Callable[..., DataFrame] | None = None,
) -> None:
    """Replace exactly the months that occur in ``trips``; all of them on ``rebuild``.

    All months become visible in one commit, or none; a month that another load replaced meanwhile
    stops this one. Rows read from month files already lie month by month: each task sorts its
    split by (zone, time) and writes it, without any shuffle. Rows in no such
    order are ``scattered``; they are first range-partitioned by (month, zone,
    time), at quantiles of a sample, which keeps files few and splits a month or zone that dominates. No
    file gets more than ``file_rows``, and each file's range of zones and times is kept beside it.

    With ``made``, ``trips`` are narrower rows that have a trip's zone and time and what its other columns follow
    from: they are moved and sorted, and ``made(rows, PARTITION)`` turns them into trips, that column beside, where they are written.
    """
    spark, base = trips.sparkSession, snapshots.current(trips.sparkSession, path)
    layout = [PARTITION, "PULocationID", "pickup_datetime"]
    rows = trips.withColumn(PARTITION, month_key(c("pickup_datetime")))
    if scattered:
        rows = rows.repartitionByRange(*layout)
    rows = rows.sortWithinPartitions(*layout)
    rows = made(rows, PARTITION) if made else rows
    parts = snapshots.stage(rows, path, PARTITION, layout[1:], file_rows)
    snapshots.commit(spark, path, base, parts, rows.drop(PARTITION).schema, PARTITION, everything=rebuild)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return snapshots.read(spark, path, version)


def read_zones(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """Trips picked up in zones ``low`` to ``high``; files of other zones are not even opened.

    The ranges of all files decide; only the names of files that may hold such trips reach the driver.
    """
    of = snapshots.ranges_of(spark, path)
    may = F.coalesce((c("low_PULocationID") <= high) & (c("high_PULocationID") >= low), F.lit(True))
    files = [r.file for r in of.where(may).select("file").collect()]
    return snapshots.read(spark, path, files=files).where(c("PULocationID").between(low, high))


def month_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per stored month, as the manifest has them; no file is opened."""
    now = snapshots.current(spark, path)
    rows = [(int(k), n) for k, n in now.rows.items()] if now else []
    return spark.createDataFrame(rows, f"{PARTITION} INT, existing BIGINT")


def partition_summary(trips: DataFrame) -> DataFrame:
    """Rows of every month partition."""
    return trips.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("rows"))


def file_counts(source: DataFrame) -> DataFrame:
    """Rows per month of any rows with ``file_month``."""
    return source.groupBy("file_month").agg(F.count(F.lit(1)).alias("expected"))


def folder_counts(spark: SparkSession, folder: months.Folder) -> DataFrame:
    """Rows per month of a folder of month files: from footers, and by reading where the month is CSV."""
    counts = footers.row_counts(folder.footers, "month").toDF("file_month", "expected")
    if folder.csv:
        counts = counts.union(file_counts(months.read(spark, folder.path).where(c("file_month").isin(*folder.csv))))
    return counts


def load_plan(expected: DataFrame, existing: DataFrame, force: bool = False) -> DataFrame:
    """What to do with each month: skip equal counts, load absent, replace the rest.

    ``expected``: (file_month, expected); ``existing``: (pickup_month, existing).
    """
    found = F.coalesce("existing", F.lit(0))
    status = (
        F.when((found == c("expected")) & ~F.lit(force), "skipped")
        .when(found == 0, "loaded")
        .otherwise("replaced")
    )
    return expected.join(existing, c("file_month") == c(PARTITION), "left").select(
        *expected.columns, found.alias("existing"), status.alias("status")
    )


def foreign_rows(source: DataFrame) -> DataFrame:
    """Per month file: rows whose pickup lies in another month."""
    foreign = ~month_key(c("pickup_datetime")).eqNullSafe(c("file_month"))
    return source.groupBy("file_month").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(foreign).alias("foreign_rows")
    )


def validate(
    spark: SparkSession, pending: DataFrame, todo: list[int], counts: DataFrame | None = None, folder: months.Folder | None = None
) -> list[str]:
    """Refuse months that break the contract; returns the warnings of the gate.

    Every part file must have the contract's columns, no row may belong to
    another month and none may miss a required value. ``counts`` are those of
    ``profile.assessed`` if the caller has them; ``folder`` is what they were read from, if they are files.
    """
    if folder:
        found = folder.footers
    else:  # the rows' own files, if they come from month files
        paths = spark.createDataFrame([(f,) for f in pending.inputFiles()], "path STRING")
        files = paths.where(c("path").rlike(months.ENTRY) & c("path").endswith(".parquet"))
        found = footers.footers(files).withColumn("month", months.month_of("path"))
    contract_checks.require_parts(found.where(c("month").isin(todo)))
    if counts is None:
        counts = profile.assessed(pending, work_folder(spark, "checks", uuid.uuid4().hex[:10]), folder)
        counts = counts.where(c("file_month").isin(todo))
    strangers = {r.file_month: r.foreign_rows for r in counts.where("foreign_rows > 0").collect()}
    if strangers:
        raise ValueError(f"rows of another month in the files of {strangers}")
    return profile.require(counts)


def load(
    spark: SparkSession, source: DataFrame, path: str, force: bool = False, rebuild: bool = False,
    counts: DataFrame | None = None, folder: months.Folder | None = None, only: list[int] | None = None,
) -> DataFrame:
    """Bring the bronze table in line with the month files; safe to repeat.

    ``force`` reloads complete months too, ``rebuild`` drops whatever is stored. ``folder`` is what ``source``
    was read from: counts and contract then come from its footers. ``only`` names the months to look at.

    Returns (file_month, expected, existing, status, rows, seconds); ``seconds`` from the start of the load
    until the month's last file was closed. Batch and stream
    both come through here, so nothing is written that ``validate`` refuses.
    Raises afterwards when a stored month does not have the file's row count.
    Only the month list, one row per month, reaches the driver.
    """
    started = time.time()
    expected = folder_counts(spark, folder) if folder else file_counts(source)
    if only:
        expected = expected.where(c("file_month").isin(only))
    steps = load_plan(expected, month_counts(spark, path), force or rebuild).collect()
    todo = [r.file_month for r in steps if r.status != "skipped"]
    if todo:
        pending = source.where(c("file_month").isin(todo))
        for warning in validate(spark, pending, todo, counts, folder):
            print("warning:", warning)
        write_months(to_bronze(pending), path, rebuild=rebuild)
    now = snapshots.current(spark, path)
    stored = {int(k): p for k, p in now.parts.items()} if now else {}
    wrong = {r.file_month: (stored[r.file_month].rows if r.file_month in stored else 0, r.expected)
             for r in steps if r.file_month not in stored or stored[r.file_month].rows != r.expected}
    if wrong:
        raise RuntimeError(f"stored and expected rows differ: {wrong}")
    return spark.createDataFrame(
        [(r.file_month, r.expected, r.existing, r.status, stored[r.file_month].rows,
          0.0 if r.status == "skipped" else max(0.0, stored[r.file_month].closed - started)) for r in steps],
        "file_month INT, expected BIGINT, existing BIGINT, status STRING, rows BIGINT, seconds DOUBLE",
    )
