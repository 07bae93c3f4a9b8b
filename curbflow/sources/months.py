"""Month files: what lies in a folder, reading it, and turning CSV into parquet.

A month is one ``fhvhv_tripdata_YYYY-MM.(csv|parquet)`` entry, either a single
file or a folder of part files. All months are read in one scan. Folders are
written aside and moved into place month by month; a mark tells a finished
parquet folder from what a broken run of something else left beside a CSV.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.contract import SOURCE_SCHEMA, ContractError, require_columns
from curbflow.session import exists
from curbflow.sources import footers

# Fixed value: naming of the published month files.
STEM = "fhvhv_tripdata_"
NAME = STEM + r"(\d{4})-(\d{2})\.(csv|parquet)"
ENTRY = rf"^(.*?{NAME})(/|$)"
CSV_OPTIONS = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
# a name that readers and listings pass over
MARK = "_COMPLETE"

c = F.col


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Data files below ``folder`` with size; contents are never opened."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .load(folder).select("path", "length")
    )


def month_of(path: str) -> Column:
    """Month of a path as an integer."""
    return F.concat(F.regexp_extract(path, ENTRY, 2), F.regexp_extract(path, ENTRY, 3)).cast("int")


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per data file of a month: month, format, entry, path, bytes."""
    return (
        listing(spark, folder)
        .where(c("path").rlike(ENTRY))
        .select(
            month_of("path").alias("month"),
            F.regexp_extract("path", ENTRY, 4).alias("format"),
            F.regexp_extract("path", ENTRY, 1).alias("entry"),
            "path", "length",
        )
    )


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """One row per (month, format): entry path, part files, bytes, whether it is a folder."""
    return (
        parts(spark, folder)
        .groupBy("month", "format", "entry")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
             F.max(c("path") != c("entry")).alias("is_folder"))
    )


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """One entry per month, parquet before CSV.

    Beside a CSV, a parquet folder counts only with the mark of a finished
    write. A few rows per month reach the driver.
    """
    best: dict[int, tuple] = {}
    found = candidates(spark, folder).collect()
    with_csv = {r.month for r in found if r.format == "csv"}
    for r in found:
        broken = (
            r.format == "parquet" and r.is_folder and r.month in with_csv
            and not exists(spark, f"{r.entry}/{MARK}")
        )
        rank = (r.format != "parquet", r.entry)
        if not broken and (r.month not in best or rank < best[r.month][0]):
            best[r.month] = (rank, (r.month, r.format, r.entry, r.files, r.bytes))
    return spark.createDataFrame(
        [row for _, row in best.values()], "month INT, format STRING, entry STRING, files BIGINT, bytes BIGINT"
    )


def chosen_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The data files of every month's chosen entry: month, format, entry, path, length."""
    chosen = inventory(spark, folder).select("entry")
    return parts(spark, folder).join(chosen, "entry", "left_semi")


@dataclass(frozen=True)
class Folder:
    """A folder of month files, and what the footers of its parquet files say, read once.

    ``footers`` has the columns of ``footers.FOOTER`` with ``month``; ``csv`` names the months that are CSV.
    """

    path: str
    footers: DataFrame
    csv: tuple[int, ...]


def inspect(spark: SparkSession, path: str, scratch: str) -> Folder:
    """Read the footers of a folder's months into ``scratch``."""
    chosen = [(r.path, r.month, r.format) for r in inventory(spark, path).select("month", "format", c("entry").alias("path")).collect()]
    files = parts(spark, path).join(
        spark.createDataFrame(chosen, "entry STRING, _month INT, _format STRING").select("entry"), "entry", "left_semi"
    )
    parquet = files.where("format = 'parquet'").select("path", "month")
    found = footers.footers(parquet, like=path).withColumn("month", month_of("path"))
    found.write.mode("overwrite").parquet(scratch)
    return Folder(path, spark.read.parquet(scratch), tuple(m for _, m, f in chosen if f == "csv"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Source rows of the chosen entry of every month, with ``file_month``.

    Only the entry names (one per month) reach the driver. ``file_month``
    comes from the file path, so a filter on it skips the other months' files.
    """
    entries = inventory(spark, folder).select("format", "entry").collect()
    return _read_entries(spark, [(r.format, r.entry) for r in entries])


def _read_entries(spark: SparkSession, entries: list[tuple[str, str]]) -> DataFrame:
    parts = []
    reader = spark.read.schema(SOURCE_SCHEMA)
    parquet = sorted(e for f, e in entries if f == "parquet")
    csv = sorted(e for f, e in entries if f == "csv")
    if parquet:
        parts.append(_with_month(reader.parquet(*parquet)))
    for names, same in _by_header(spark, csv).items():
        # every file's own header is held against the names, and a bad line stops the read
        schema = T.StructType([SOURCE_SCHEMA[n] for n in names])
        strict = spark.read.schema(schema).options(**CSV_OPTIONS, enforceSchema="false", mode="FAILFAST")
        parts.append(_with_month(strict.csv(same)).select(*SOURCE_SCHEMA.fieldNames(), "file_month"))
    if not parts:
        raise FileNotFoundError("no month files found")
    return reduce(DataFrame.unionByName, parts)


def _by_header(spark: SparkSession, entries: list[str]) -> dict[tuple[str, ...], list[str]]:
    """CSV entries by the order of their columns; raises if one does not have the contract's."""
    out = defaultdict(list)
    for entry in entries:
        names = spark.read.option("header", "true").csv(entry).columns
        require_columns(names, entry)
        out[tuple(names)].append(entry)
    return out


def _with_month(df: DataFrame) -> DataFrame:
    # evaluated per row, so by position and not by pattern: YYYY-MM after the stem
    stamp = F.substring_index(c("_metadata.file_path"), STEM, -1)
    month = F.concat(stamp.substr(1, 4), stamp.substr(6, 2)).cast("int")
    return df.select("*", month.alias("file_month"))


def write(rows: DataFrame, folder: str, fmt: str = "parquet") -> None:
    """Write source rows as month entries below ``folder`` in a single job.

    A month that is there already gets further part files.
    """
    _publish(rows.sparkSession, _aside(rows, folder, fmt), folder)


def _aside(rows: DataFrame, folder: str, fmt: str) -> str:
    """Month entries in a folder of their own below ``folder`` that readers pass over."""
    path = f"{folder}/_incoming-{uuid.uuid4().hex[:10]}"
    # by the number and not by the name: rows that come month by month are written as they come
    writer = rows.write.partitionBy("file_month")
    if fmt == "csv":
        writer.options(**CSV_OPTIONS).csv(path)
    else:
        writer.option("compression", "zstd").parquet(path)
    _name_months(rows.sparkSession, path, fmt)
    return path


def _name_months(spark: SparkSession, aside: str, fmt: str) -> None:
    """Folders by month number get the names of the month files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(aside).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for month in fs.listStatus(path(aside)):
        key = month.getPath().getName().partition("=")[2]
        if month.isDirectory() and key:
            name = f"{STEM}{key[:4]}-{key[4:6]}.{fmt}" if key.isdigit() else key
            if not fs.rename(month.getPath(), path(aside, f"file={name}")):
                raise OSError(f"{month.getPath().toString()} could not be renamed to {name}")


def _publish(spark: SparkSession, aside: str, folder: str, replace: bool = False) -> None:
    """Mark the finished months and move each into place by one rename."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(aside).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for month in fs.listStatus(path(aside)):
        if not month.isDirectory():
            continue
        done, target = month.getPath(), path(folder, month.getPath().getName())
        fs.create(path(done, MARK)).close()
        if replace and fs.exists(target):
            fs.delete(target, True)
        moves = [(done, target)] if not fs.exists(target) else [
            (part.getPath(), path(target, part.getPath().getName()))
            for part in fs.listStatus(done) if not part.getPath().getName().startswith("_")
        ]
        for old, new in moves:
            if not fs.rename(old, new):
                raise OSError(f"{old.toString()} could not be moved to {new.toString()}")
    fs.delete(path(aside), True)


def csv_to_parquet(spark: SparkSession, folder: str) -> int:
    """Convert every month that exists only as CSV; returns how many there were.

    All pending months go through one job into a folder aside. Only when every
    month there has as many rows as its CSV are they moved into place.
    """
    pending = inventory(spark, folder).where("format = 'csv'").select("format", "entry").collect()
    if pending:
        rows = _read_entries(spark, [(r.format, r.entry) for r in pending])
        aside = _aside(rows, folder, "parquet")
        written = _with_month(spark.read.schema(SOURCE_SCHEMA).parquet(f"{aside}/*"))
        count = lambda df: {r.file_month: r["count"] for r in df.groupBy("file_month").count().collect()}
        if count(rows) != count(written):
            raise ContractError(f"{folder}: converted months do not have the rows of their CSV files")
        _publish(spark, aside, folder, replace=True)
    return len(pending)
