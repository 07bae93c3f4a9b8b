"""Clock changes of a time zone, from the time zone data Spark runs with."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: where the trips are.
ZONE = "America/New_York"
FIRST, LAST = "2000-01-01", "2099-12-31"

_known: dict[tuple[str, str], dict] = {}


def transitions(spark: SparkSession, zone: str = ZONE, first: str = FIRST, last: str = LAST) -> DataFrame:
    """(day, shift_seconds): the local dates whose two midnights have different offsets from UTC.

    A further year, or another zone's rules, need other time zone data only.
    """
    days = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("day")
    )

    def offset(day):
        local = day.cast("timestamp_ntz")
        return F.timestamp_diff("SECOND", F.convert_timezone(F.lit(zone), F.lit("UTC"), local), local)

    shift = offset(F.date_add("day", 1)) - offset(F.col("day"))
    return days.select("day", shift.alias("shift_seconds")).where("shift_seconds <> 0")


def days(spark: SparkSession | None = None, zone: str = ZONE) -> dict[int, list[dt.date]]:
    """The local dates of change by their shift in seconds, some two hundred, worked out once an application."""
    spark = spark or SparkSession.active()
    key = (spark.sparkContext.applicationId, zone)
    if key not in _known:
        found: dict[int, list[dt.date]] = {3600: [], -3600: []}
        for r in transitions(spark, zone).orderBy("day").collect():
            found.setdefault(r.shift_seconds, []).append(r.day)
        _known[key] = found
    return _known[key]
