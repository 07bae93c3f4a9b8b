"""CSV files for spreadsheets: UTF-8 with a byte order mark, strings quoted.

Lines are built as text, because numbers stay bare while strings, dates and
the header are quoted. Parts are globally sorted; mark and header are the first
line of the first, so that the parts in order are one CSV file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.functions.fixed import plain_number

BOM = "\ufeff"
NULL = "\\N"
# Dimensions by which an export is sorted, in this order of preference.
DIMENSIONS = [
    "month", "trip_date", "airport", "direction", "hour_of_day", "day_of_week",
    "distance_bin_miles", "bucket_order", "segment", "pu_zone_name", "pu_location_id",
    "operator", "check_group", "column_name", "file_name", "location_id",
]
SORT_COLUMNS = 4


def sort_columns(columns: list[str]) -> list[str]:
    """The first four known dimensions, else the first column."""
    dims = [d for d in DIMENSIONS if d in columns]
    return dims[:SORT_COLUMNS] or columns[:1]


def sorted_by_dimensions(df: DataFrame) -> DataFrame:
    return df.orderBy(*sort_columns(df.columns))


def _text(field: T.StructField) -> Column:
    col = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        text = plain_number(col)
    elif isinstance(field.dataType, (T.IntegralType, T.BooleanType)):
        text = col.cast("string")
    else:
        doubled = F.regexp_replace(col.cast("string"), '"', '""')
        text = F.concat(F.lit('"'), doubled, F.lit('"'))
    return F.coalesce(text, F.lit(NULL))


def header(columns: list[str], sep: str = ",") -> str:
    return BOM + sep.join(f'"{n}"' for n in columns)


def lines(df: DataFrame, sep: str = ",") -> DataFrame:
    """``value``: the header line, then one text line per row sorted by the table's dimensions."""
    keys = sort_columns(df.columns)
    text = F.concat_ws(sep, *[_text(f) for f in df.schema.fields])
    rows = df.select(
        text.alias("value"), F.lit(1).alias("place"), *[F.col(k).alias(f"by{i}") for i, k in enumerate(keys)]
    )
    top = df.sparkSession.createDataFrame([(header(df.columns, sep), 0)], "value STRING, place INT")
    top = top.select("*", *[F.lit(None).cast(rows.schema[f"by{i}"].dataType).alias(f"by{i}") for i in range(len(keys))])
    return rows.unionByName(top).orderBy("place", *[f"by{i}" for i in range(len(keys))]).select("value")


def export(df: DataFrame, path: str, sep: str = ",", single: bool = False) -> int:
    """Write one table sorted by its dimensions; returns the rows written.

    ``single`` asks for one file, written by one task; what is written does not
    depend on the size.
    """
    seen = Observation()
    text = lines(df, sep).observe(seen, F.count(F.lit(1)).alias("lines"))
    (text.coalesce(1) if single else text).write.mode("overwrite").text(path)
    return seen.get["lines"] - 1  # the header


def export_all(
    tables: dict[str, DataFrame], out: str, sep: str = ",", single: bool = False
) -> list[tuple[str, int | None, str]]:
    """Export several tables; a failing one is reported and the rest go on."""
    report = []
    for name, df in tables.items():
        try:
            report.append((name, export(df, f"{out}/{name}.csv", sep, single), "ok"))
        except Exception as exc:  # noqa: BLE001
            report.append((name, None, str(exc).splitlines()[0]))
    return report


def export_summary(spark, report: list[tuple[str, int | None, str]], out: str) -> DataFrame:
    """Rows, part files and bytes of every exported table."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "part-*").load(out)
        .select(F.regexp_extract("path", r"([^/]+)\.csv/[^/]*$", 1).alias("table_name"), "length")
        .groupBy("table_name").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )
    done = spark.createDataFrame(report, "table_name STRING, rows BIGINT, status STRING")
    return done.join(files, "table_name", "left")
