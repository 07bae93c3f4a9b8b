"""Row rules of a trip: operator, waiting, silver filter, segments, bins, flags.

Every rule is one Column, defined once and shared by marts, checks and reports.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.functions.fixed import cents, milli

c = F.col

# Licences, airport zones, thresholds and bucket edges.
OPERATORS = {"HV0003": "Uber", "HV0005": "Lyft"}
AIRPORTS = {132: "JFK", 138: "LaGuardia", 1: "Newark"}
MIN_TRIP_SECONDS = 30
MAX_MPH = 100
MAX_WAIT_SECONDS = 7200
LONG_WAIT_SECONDS = 600
VERY_LONG_WAIT_SECONDS = 900
TAIL_MILE_BIN = 60
WAIT_EDGES = [30, 60, 120, 180, 240, 300, 360, 480, 600, 900, 1200, 1500, 1800]
WAIT_LABELS = [
    "0-30 сек", "30-60 сек", "1-2 мин", "2-3 мин", "3-4 мин", "4-5 мин", "5-6 мин",
    "6-8 мин", "8-10 мин", "10-15 мин", "15-20 мин", "20-25 мин", "25-30 мин", "30+ мин",
]
MINUTE_BUCKETS = 16
# what the passenger is charged, without tips, and the short names used in sums
CHARGE_NAMES = {
    "base_passenger_fare": "base", "tolls": "tolls", "bcf": "bcf", "sales_tax": "tax",
    "congestion_surcharge": "congestion", "airport_fee": "airport_fee",
    "cbd_congestion_fee": "cbd",
}


def operator_name(licence: Column | None = None) -> Column:
    licence = c("hvfhs_license_num") if licence is None else licence
    known = F
    for code, name in OPERATORS.items():
        known = known.when(licence == code, name)
    return known.otherwise(licence)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    # interval of two zoneless times: no session zone can shift it
    return (_c(end) - _c(start)).cast("interval second").cast("bigint")


def wait_seconds() -> Column:
    return seconds_between("request_datetime", "pickup_datetime")


def wait_valid(wait: Column | None = None) -> Column:
    return (wait_seconds() if wait is None else wait).between(0, MAX_WAIT_SECONDS)


def scheduled(wait: Column | None = None) -> Column:
    return (wait_seconds() if wait is None else wait) < 0


def duration_valid() -> Column:
    return c("dropoff_datetime") > c("pickup_datetime")


def duration_diff() -> Column:
    """Metered seconds minus the difference of the time stamps."""
    return c("trip_time") - seconds_between("pickup_datetime", "dropoff_datetime")


def too_fast() -> Column:
    """Above the speed limit, without a division so zero seconds cannot raise."""
    return milli("trip_miles") * 3600 > c("trip_time") * (MAX_MPH * 1000)


def silver_predicate() -> Column:
    # the four plain comparisons are pushed into the parquet scan
    return (
        (c("trip_miles") > 0)
        & (c("trip_time") >= MIN_TRIP_SECONDS)
        & (c("base_passenger_fare") > 0)
        & (c("driver_pay") > 0)
        & ~too_fast()
    )


def silver(trips: DataFrame) -> DataFrame:
    return trips.where(silver_predicate())


def total_fare_cents() -> Column:
    """All charges to the passenger, without tips."""
    return reduce(lambda a, b: a + b, [cents(x) for x in CHARGE_NAMES])


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "MM")


def day_of_week(ts: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(ts) + 1


def is_airport(zone: Column) -> Column:
    return zone.isin(*AIRPORTS)


def airport_name(zone: Column) -> Column:
    named = F
    for code, name in AIRPORTS.items():
        named = named.when(zone == code, name)
    return named


def segment(pickup: Column, dropoff: Column, pu_borough: Column, do_borough: Column) -> Column:
    """First match wins: either end an airport, either end in Manhattan, the rest."""
    return (
        F.when(is_airport(pickup) | is_airport(dropoff), "Airport")
        .when((pu_borough == "Manhattan") | (do_borough == "Manhattan"), "Manhattan")
        .otherwise("Regular")
    )


def wait_bucket(wait: Column) -> Column:
    """Order number 1..14 of the uneven waiting buckets."""
    bucket = F
    for i, edge in enumerate(WAIT_EDGES, start=1):
        bucket = bucket.when(wait < edge, i)
    return bucket.otherwise(len(WAIT_LABELS))


def wait_bucket_label(bucket: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in WAIT_LABELS]), bucket)


def wait_minute_bucket(wait: Column) -> Column:
    """Order number 1..16 of one-minute buckets with an open tail."""
    return (F.least(F.floor(wait / 60), F.lit(MINUTE_BUCKETS - 1)) + 1).cast("int")


def wait_minute_label(bucket: Column) -> Column:
    lower = (bucket - 1).cast("string")
    return F.when(bucket == MINUTE_BUCKETS, F.concat(lower, F.lit("+ мин"))).otherwise(
        F.concat(lower, F.lit("-"), bucket.cast("string"), F.lit(" мин"))
    )


def mile_bin(miles: Column) -> Column:
    return F.least(F.floor(miles), F.lit(TAIL_MILE_BIN)).cast("int")


def flag(name: str) -> Column:
    return F.coalesce(c(name), F.lit(False))


def measures(trips: DataFrame) -> DataFrame:
    """Silver trips with every derived column the aggregates use.

    A lazy projection: each query keeps only the columns it reads, down to the
    scan. ``wait`` is NULL unless the waiting time is meaningful, so waiting
    aggregates need no further filter.
    """
    ts, charges = c("pickup_datetime"), list(CHARGE_NAMES.values())
    staged = silver(trips).withColumn("wait_sec", wait_seconds())
    return staged.select(
        F.to_date(ts).alias("trip_date"),
        month_start(ts).alias("month"),
        F.hour(ts).alias("hour_of_day"),
        day_of_week(ts).alias("day_of_week"),
        operator_name().alias("operator"),
        c("PULocationID").alias("pu_location_id"),
        c("DOLocationID").alias("do_location_id"),
        "wait_sec",
        F.when(wait_valid(c("wait_sec")), c("wait_sec")).alias("wait"),
        c("trip_time").alias("secs"),
        milli("trip_miles").alias("milli"),
        mile_bin(c("trip_miles")).alias("mile_bin"),
        *[cents(source).alias(name) for source, name in CHARGE_NAMES.items()],
        cents("tips").alias("tips"),
        cents("driver_pay").alias("pay"),
        flag("shared_request_flag").alias("shared_request"),
        flag("shared_match_flag").alias("shared_match"),
        flag("wav_request_flag").alias("wav_request"),
        flag("wav_match_flag").alias("wav_match"),
        flag("access_a_ride_flag").alias("aar"),
    ).withColumns({
        # from the cents above, so each amount is converted once per row
        "total": F.expr(" + ".join(charges)),
        "regular": F.expr("NOT (shared_request OR shared_match OR wav_request OR wav_match OR aar)"),
    })


def _c(x: Column | str) -> Column:
    return c(x) if isinstance(x, str) else x
