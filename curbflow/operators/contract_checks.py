"""Comparing what is there with the contract, from schemas alone (no scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.contract import SOURCE_SCHEMA, TRIP_SCHEMA, ContractError, compare_columns, require_columns
from curbflow.sources import footers, months


def month_schemas(found: DataFrame) -> list[tuple[int, list[tuple[str, str]], str]]:
    """Distinct (month, columns with types) of footers with ``month``, with one of their paths.

    The footers of all parts are read by a distributed job; only distinct states reach the driver.
    """
    fields = F.array_sort(F.collect_list(F.struct("position", "column_name", "type")))
    each = found.where("row_group = 0").groupBy("path", "month").agg(fields.alias("fields"))
    states = each.groupBy("month", "fields").agg(F.min("path").alias("path")).collect()
    return [(r.month, [(f.column_name, f.type) for f in r.fields], r.path) for r in states]


def _folder_schemas(spark: SparkSession, folder: str) -> list[tuple[int, list[tuple[str, str]], str]]:
    files = months.chosen_parts(spark, folder).where("format = 'parquet'").select("path")
    return month_schemas(footers.footers(files).withColumn("month", months.month_of("path")))


def month_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Column comparison of every month entry, over the footers of all its parts.

    A row for each state that a column has in some part, so a month whose parts
    agree has one row per column.
    """
    rows = {
        (month, *state)
        for month, fields, _ in _folder_schemas(spark, folder)
        for state in compare_columns([name for name, _ in fields])
    }
    return spark.createDataFrame(
        sorted(rows, key=str),
        "file_month INT, column_name STRING, status STRING, "
        "expected_position INT, actual_position INT",
    )


def month_types(spark: SparkSession, folder: str) -> DataFrame:
    """Type comparison of every month entry with the source contract, over the footers of all its parts."""
    want = {f.name: f.dataType.simpleString() for f in SOURCE_SCHEMA.fields}
    rows = {
        (month, *state)
        for month, fields, _ in _folder_schemas(spark, folder)
        for state in _states(dict(fields), want)
    }
    return spark.createDataFrame(sorted(rows, key=str), f"file_month INT, {_TYPE_STATE}")


def require_parts(found: DataFrame) -> None:
    """Raise unless every parquet file of ``found``, footers with ``month``, has exactly the contract's columns."""
    for _, fields, path in month_schemas(found):
        require_columns([name for name, _ in fields], path)


_TYPE_STATE = "column_name STRING, expected_type STRING, actual_type STRING, status STRING"


def _type_states(
    actual: T.StructType, expected: T.StructType
) -> list[tuple[str, str | None, str | None, str]]:
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    return _states({f.name: f.dataType.simpleString() for f in actual.fields}, want)


def _states(have: dict[str, str], want: dict[str, str]) -> list[tuple[str, str | None, str | None, str]]:
    return [
        (n, want.get(n), have.get(n),
         "ok" if want.get(n) == have.get(n) else
         "missing" if n not in have else "extra" if n not in want else "type")
        for n in [*want, *(n for n in have if n not in want)]
    ]


def type_drift(
    spark: SparkSession, actual: T.StructType, expected: T.StructType = TRIP_SCHEMA
) -> DataFrame:
    """Columns of a stored table whose type differs, are absent, or are unknown."""
    return spark.createDataFrame(_type_states(actual, expected), _TYPE_STATE)


def require_types(actual: T.StructType, migrate: bool = False) -> bool:
    """True when the table may be used as it is, False when it is to be rebuilt.

    Differences raise unless ``migrate`` asks for the rebuild.
    """
    want = {f.name: f.dataType for f in TRIP_SCHEMA.fields}
    have = {f.name: f.dataType for f in actual.fields}
    drift = sorted(n for n in want.keys() | have.keys() if want.get(n) != have.get(n))
    if drift and not migrate:
        raise ContractError(f"table differs from the contract in {', '.join(drift)}")
    return not drift
