"""Profiling month files before they are loaded: NULLs, empty and repeated rows.

Everything is per month file and covers all files in one pass; the verdicts of
the gate follow from the same numbers.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.contract import COLUMNS, MAY_BE_NULL, month_key
from curbflow.functions.fixed import ratio
from curbflow.sources import months

c = F.col
EMPTY = "empty rows (все поля NULL)"
REPEATED = "full duplicate rows"


class GateError(RuntimeError):
    """A month file breaks the contract and must not be loaded."""


def null_counts(source: DataFrame) -> DataFrame:
    """Wide: per file the row count, NULLs of each column, all-NULL rows, rows of another month."""
    empty = reduce(and_, [c(x).isNull() for x in COLUMNS])
    foreign = ~month_key(c("pickup_datetime")).eqNullSafe(c("file_month"))
    return source.groupBy("file_month").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(empty).alias("empty_rows"),
        F.count_if(foreign).alias("foreign_rows"),
        *[F.count_if(c(x).isNull()).alias(x) for x in COLUMNS],
    )


def folder_counts(source: DataFrame, folder: months.Folder) -> DataFrame:
    """:func:`null_counts` of month files, from their footers where those decide.

    Footers give rows and NULLs. No row is empty where some column has no NULL at all, and none is of another
    month where the least and greatest pickup are not. Months that this leaves open, and months in CSV, are read.
    """
    spark = source.sparkSession
    month = lambda x: F.regexp_replace(F.substring(x, 1, 7), "-", "").cast("int")
    here = c("column_name") == "pickup_datetime"
    at_home = month("low").eqNullSafe(c("month")) & month("high").eqNullSafe(c("month")) & (c("nulls") == 0)
    found = folder.footers.groupBy(c("month").alias("file_month")).agg(
        F.sum(F.when(c("position") == 0, c("rows")).otherwise(0)).alias("rows"),
        *[F.sum(F.when(c("column_name") == x, c("nulls"))).alias(x) for x in COLUMNS],
        F.bool_and(c("nulls").isNotNull()).alias("told"),
        F.bool_and(~here | at_home | (c("rows") == 0)).alias("home"),
    )
    full = reduce(or_, [c(x) == 0 for x in COLUMNS])
    sure = F.coalesce(c("told") & c("home") & full & reduce(and_, [c(x).isNotNull() for x in COLUMNS]), F.lit(False))
    zero = F.lit(0).cast("bigint")
    table = found.withColumn("sure", sure)
    table = spark.createDataFrame(table.collect(), table.schema)  # a row per month
    decided = table.where("sure").select("file_month", "rows", zero.alias("empty_rows"), zero.alias("foreign_rows"), *COLUMNS)
    rest = [r.file_month for r in table.where("not sure").select("file_month").collect()] + list(folder.csv)
    return decided.union(null_counts(source.where(c("file_month").isin(rest)))) if rest else decided


def counted(source: DataFrame, folder: months.Folder | None) -> DataFrame:
    return folder_counts(source, folder) if folder else null_counts(source)


def with_duplicates(counts: DataFrame, source: DataFrame, scratch: str) -> DataFrame:
    """``counts`` with the exact number of repeated rows."""
    return counts.join(repeated_rows(source, scratch), "file_month", "left").fillna(0, ["duplicate_rows"])


def assessed(source: DataFrame, scratch: str, folder: months.Folder | None = None) -> DataFrame:
    """All counts of every month, from footers or one pass and one duplicate job, stored under ``scratch``.

    Profile, anomalies and verdict below read this table; a row per month. ``folder`` is what
    ``source`` was read from, if from files.
    """
    spark = source.sparkSession
    counted(source, folder).write.mode("overwrite").parquet(f"{scratch}/counts")
    repeated_rows(source, f"{scratch}/hashes").write.mode("overwrite").parquet(f"{scratch}/repeated")
    counts, repeated = (spark.read.parquet(f"{scratch}/{x}") for x in ("counts", "repeated"))
    return counts.join(repeated, "file_month", "left").fillna(0, ["duplicate_rows"])


def null_profile(counts: DataFrame) -> DataFrame:
    """Long: (file_month, column_name, null_count, null_pct, expected)."""
    long = counts.unpivot(["file_month", "rows"], COLUMNS, "column_name", "null_count")
    return long.select(
        "file_month", "column_name", "null_count",
        F.coalesce(ratio("null_count", "rows", 4, times=100), F.lit(0.0)).alias("null_pct"),
        (c("column_name").isin(*MAY_BE_NULL) | (c("null_count") == 0)).alias("expected"),
    )


def empty_rows(counts: DataFrame) -> DataFrame:
    return counts.select("file_month", "rows", "empty_rows")


def repeated_rows(source: DataFrame, scratch: str) -> DataFrame:
    """Rows that repeat an earlier row of their file in all columns, exactly; files without any are absent.

    Shuffling whole rows is avoided: a first pass moves only a row hash and
    keeps the hashes that occur twice. They are written to ``scratch``, so
    their real size decides whether the second pass broadcasts them; that pass
    compares complete rows (NULLs equal) among the suspects alone.
    """
    spark = source.sparkSession
    hashed = source.withColumn("row_hash", F.xxhash64(*COLUMNS))
    (
        hashed.groupBy("file_month", "row_hash").count().where("count > 1")
        .select("file_month", "row_hash").write.mode("overwrite").parquet(scratch)
    )
    suspects = hashed.join(spark.read.parquet(scratch), ["file_month", "row_hash"], "left_semi")
    return (
        suspects.groupBy("file_month", *COLUMNS).count()
        .groupBy("file_month").agg(F.sum(c("count") - 1).alias("duplicate_rows"))
    )


def duplicate_rows(counts: DataFrame) -> DataFrame:
    return counts.select("file_month", "rows", "duplicate_rows")


def _long(counts: DataFrame, check: str, column: str, note: str) -> DataFrame:
    return counts.select(
        "file_month", "rows", F.lit(check).alias("check_name"),
        c(column).alias("rows_affected"), F.lit(note).alias("note"),
    )


def source_anomalies(counts: DataFrame) -> DataFrame:
    """Empty and repeated rows as rows of the anomaly table."""
    long = _long(counts, EMPTY, "empty_rows", "excluded").unionByName(
        _long(counts, REPEATED, "duplicate_rows", "flagged")
    )
    return long.select(
        "file_month", c("check_name").alias("metric_name"), "rows_affected",
        F.coalesce(ratio("rows_affected", "rows", 4, times=100), F.lit(0.0)).alias("share_pct"),
        c("note").alias("action_taken"),
    )


def gate(counts: DataFrame) -> DataFrame:
    """(file_month, check_name, rows_affected, verdict): pass, warn or fail."""
    required = [x for x in COLUMNS if x not in MAY_BE_NULL]
    together = F.aggregate(F.array(*required), F.lit(0).cast("bigint"), lambda a, b: a + b)
    checks = counts.select(
        "file_month", together.alias("unexpected_nulls"), "empty_rows", "duplicate_rows"
    ).unpivot("file_month", ["unexpected_nulls", "empty_rows", "duplicate_rows"], "check_name", "rows_affected")
    bad = F.when(c("check_name") == "duplicate_rows", "warn").otherwise("fail")
    return checks.withColumn("verdict", F.when(c("rows_affected") == 0, "pass").otherwise(bad))


def require(counts: DataFrame) -> list[str]:
    """Raise when a file fails the gate; return the warnings. A few rows per month."""
    rows = gate(counts).where("verdict <> 'pass'").collect()
    text = [f"{r.file_month}: {r.check_name} {r.rows_affected}" for r in rows]
    if any(r.verdict == "fail" for r in rows):
        raise GateError("; ".join(text))
    return text
