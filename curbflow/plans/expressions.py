"""Each row rule on the whole bronze table, folded to its distinct outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbflow.contract import FLAGS, PARTITION, month_key, to_bronze
from curbflow.functions import trip as t
from curbflow.functions.fixed import cents, dollars, ratio
from curbflow.functions.grouping import fold, tally, unfold
from curbflow.operators import quality
from curbflow.plans.marts import airport_ends, named_zones

c = F.col


def _outcomes(df: DataFrame, **columns: Column) -> DataFrame:
    """Trips per combination of the given outcomes."""
    return df.groupBy(*[v.alias(k) for k, v in columns.items()]).agg(
        F.count(F.lit(1)).alias("trips")
    )


def operator(trips: DataFrame) -> DataFrame:
    return _outcomes(trips, hvfhs_license_num=c("hvfhs_license_num"), operator=t.operator_name())


def wait(trips: DataFrame) -> DataFrame:
    return _outcomes(trips, wait_sec=t.wait_seconds())


def silver(trips: DataFrame) -> DataFrame:
    """Rows per month before and after the physical quality filter."""
    return trips.groupBy(PARTITION).agg(
        F.count(F.lit(1)).alias("bronze_trips"),
        F.count_if(t.silver_predicate()).alias("silver_trips"),
    ).withColumn("silver_pct", ratio("silver_trips", "bronze_trips", 4, times=100))


def wait_valid(trips: DataFrame) -> DataFrame:
    w = t.wait_seconds()
    return trips.groupBy(t.wait_valid(w).alias("wait_valid")).agg(
        F.count(F.lit(1)).alias("trips"), F.min(w).alias("least"), F.max(w).alias("most")
    )


def scheduled(trips: DataFrame) -> DataFrame:
    return _outcomes(trips, operator=t.operator_name(), scheduled=t.scheduled())


def duration_valid(trips: DataFrame) -> DataFrame:
    return _outcomes(trips, operator=t.operator_name(), duration_valid=t.duration_valid())


def total_fare(trips: DataFrame) -> DataFrame:
    return _outcomes(trips, total_fare=dollars(t.total_fare_cents()))


def time_parts(trips: DataFrame) -> DataFrame:
    ts = c("pickup_datetime")
    return _outcomes(
        trips, trip_date=F.to_date(ts), month=t.month_start(ts), hour_of_day=F.hour(ts),
        day_of_week=t.day_of_week(ts), pickup_month=c(PARTITION),
    )


def segment(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Segment of every pair of zones, with its trips."""
    pairs = _outcomes(trips, pu_location_id=c("PULocationID"), do_location_id=c("DOLocationID"))
    named = named_zones(named_zones(pairs, zones, "pu_location_id", "pu"), zones,
                        "do_location_id", "do")
    return named.select(
        "pu_location_id", "do_location_id",
        t.segment(c("pu_location_id"), c("do_location_id"), c("pu_borough"), c("do_borough"))
        .alias("segment"), "trips",
    )


def _bucketed(trips: DataFrame, bucket, label) -> DataFrame:
    w = t.wait_seconds()
    valid = trips.select(w.alias("w")).where(t.wait_valid(c("w")))
    out = valid.groupBy(bucket(c("w")).alias("bucket_order")).agg(
        F.count(F.lit(1)).alias("trips"), F.min("w").alias("least"), F.max("w").alias("most")
    )
    return out.withColumn("wait_bucket", label(c("bucket_order")))


def wait_buckets(trips: DataFrame) -> DataFrame:
    return _bucketed(trips, t.wait_bucket, t.wait_bucket_label)


def wait_minute_buckets(trips: DataFrame) -> DataFrame:
    return _bucketed(trips, t.wait_minute_bucket, t.wait_minute_label)


def mile_bins(trips: DataFrame) -> DataFrame:
    return trips.groupBy(t.mile_bin(c("trip_miles")).alias("mile_bin")).agg(
        F.count(F.lit(1)).alias("trips"), F.min("trip_miles").alias("least"),
        F.max("trip_miles").alias("most"),
    )


def dst(trips: DataFrame) -> DataFrame:
    return _outcomes(trips, **quality.dst_flags())


def clock_changes(trips: DataFrame, transitions: DataFrame) -> DataFrame:
    """Per clock change within the time covered: trips picked up that day, and the days to the next change."""
    daily = trips.groupBy(F.to_date("pickup_datetime").alias("day")).agg(F.count(F.lit(1)).alias("trips"))
    following = F.lead("day").over(Window.orderBy("day"))  # some two hundred rows
    known = transitions.withColumn("days_to_next", F.datediff(following, "day"))
    return known.join(daily, "day").select("day", c("shift_seconds").cast("bigint").alias("shift_seconds"), "days_to_next", "trips")


def duration_diff(trips: DataFrame) -> DataFrame:
    return _outcomes(trips, duration_diff=t.duration_diff())


def airport_names(trips: DataFrame) -> DataFrame:
    return _outcomes(trips, pu_location_id=c("PULocationID"), airport=t.airport_name(c("PULocationID")))


def regular_cohort(measures: DataFrame) -> DataFrame:
    return _outcomes(
        measures, operator=c("operator"), cohort_regular=c("wait").isNotNull() & c("regular")
    )


# ── joins, union, order ──────────────────────────────────────────────────────

def by_pickup_zone(measures: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips by id with the zone name of the dimension (unmatched ids stay, unnamed)."""
    counts = _outcomes(measures, pu_location_id=c("pu_location_id"))
    return named_zones(counts, zones, "pu_location_id", "pu")


def by_both_zones(measures: DataFrame, zones: DataFrame) -> DataFrame:
    counts = _outcomes(
        measures, pu_location_id=c("pu_location_id"), do_location_id=c("do_location_id")
    )
    named = named_zones(named_zones(counts, zones, "pu_location_id", "pu"), zones,
                        "do_location_id", "do")
    return named.groupBy("pu_borough", "do_borough").agg(F.sum("trips").alias("trips"))


def with_totals(measures: DataFrame) -> DataFrame:
    """Month and month x operator totals joined back to a finer aggregate."""
    fine = _outcomes(
        measures, month=c("month"), operator=c("operator"), hour_of_day=c("hour_of_day")
    )
    by_operator = fine.groupBy("month", "operator").agg(F.sum("trips").alias("operator_trips"))
    by_month = by_operator.groupBy("month").agg(F.sum("operator_trips").alias("month_trips"))
    return fine.join(by_operator, ["month", "operator"]).join(by_month, "month").withColumn(
        "share_pct", ratio("trips", "operator_trips", 4, times=100)
    )


def directions(measures: DataFrame) -> DataFrame:
    """Airport ends: a trip between two airports counts in both directions."""
    both = t.is_airport(c("pu_location_id")) & t.is_airport(c("do_location_id"))
    ends = airport_ends(measures.withColumn("both_ends", both))
    return _outcomes(ends, airport=c("airport"), direction=c("direction"), both_ends=c("both_ends"))


def bronze_by_month(source: DataFrame) -> DataFrame:
    """What reading the month files into contract types yields, month by month."""
    typed = to_bronze(source).withColumn("month", month_key(c("pickup_datetime")))
    return typed.groupBy("month").agg(
        F.count(F.lit(1)).alias("trips"),
        *[F.count_if(c(f)).alias(f) for f in FLAGS],
        dollars(F.sum(cents("base_passenger_fare"))).alias("sum_base_fare"),
        F.count("on_scene_datetime").alias("on_scene_known"),
        F.count("originating_base_num").alias("originating_known"),
    )


def aggregate_functions(measures: DataFrame) -> DataFrame:
    """Every kind of aggregate the marts use, on one grain.

    Conditional sums give 0 and conditional means NULL for an empty group; a
    distinct count of several columns counts them as one struct, so rows with
    a NULL are not dropped; quantiles come from sorted folded rows.
    """
    sums = {
        "scheduled": tally("wait_sec < 0"),
        "shared_wait_sec": "CASE WHEN shared_request AND wait IS NOT NULL THEN wait ELSE 0L END",
        "shared_waits": tally("shared_request AND wait IS NOT NULL"),
        "shared_late": tally("shared_request AND wait > 600"),
        "secs": "secs", "milli": "milli",
    }
    keys = ["month", "operator"]
    base = unfold(fold(measures, keys, sums, "wait"), keys, list(sums), "wait", {"wait_p50": 0.5})
    others = measures.groupBy(*keys).agg(
        F.max("secs").alias("max_secs"),
        F.count_distinct(F.struct("pu_location_id", "wait")).alias("zone_waits"),
    )
    return base.join(others, keys).select(
        *keys, "trips", "scheduled", "shared_wait_sec", "max_secs", "zone_waits",
        F.round("wait_p50", 1).alias("wait_p50"),
        ratio("secs", "trips", 4).alias("avg_secs"),
        ratio("shared_late", "shared_waits", 4).alias("share_shared_late"),
        ratio("milli", "secs", 2, times=18, unit=5).alias("mph"),
    )


def zone_trips(trips: DataFrame) -> DataFrame:
    """Trips and miles per month and pickup zone."""
    return trips.groupBy(PARTITION, c("PULocationID").alias("pu_location_id")).agg(
        F.count(F.lit(1)).alias("trips"), F.max("pickup_datetime").alias("last_pickup")
    )


def _stretches(batches):
    """Runs of neighbouring rows of a file as one task reads them: their ends, rows, and pairs out of order."""
    import numpy as np
    import pandas as pd

    for frame in batches:
        if not len(frame):
            continue
        file, at = frame["file"].to_numpy(), frame["at"].to_numpy()
        zone, time = frame["zone"].to_numpy(), frame["time"].to_numpy()
        new = np.concatenate([[True], (file[1:] != file[:-1]) | (at[1:] != at[:-1] + 1)])
        down = np.concatenate([[False], (zone[1:] < zone[:-1]) | ((zone[1:] == zone[:-1]) & (time[1:] < time[:-1]))]) & ~new
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(frame)) - 1
        yield pd.DataFrame({
            "month": frame["month"].to_numpy()[first], "file": file[first], "at": at[first], "rows": last - first + 1,
            "first_zone": zone[first], "first_time": time[first], "last_zone": zone[last], "last_time": time[last],
            "broken": np.add.reduceat(down.astype(np.int64), first),
        })


def stored_order(trips: DataFrame) -> DataFrame:
    """Rows of each month that break the (zone, time) order of their stored file.

    Rows are compared with their neighbours in the task that reads them and stay there; only the ends of each
    stretch of a file are brought together.
    """
    placed = trips.select(
        c(PARTITION).alias("month"), c("_metadata.file_path").alias("file"), c("_metadata.row_index").alias("at"),
        F.coalesce(c("PULocationID"), F.lit(-1)).alias("zone"),
        F.coalesce(F.unix_micros(c("pickup_datetime").cast("timestamp")), F.lit(0)).alias("time"),
    )
    ends = "first_zone INT, first_time BIGINT, last_zone INT, last_time BIGINT"
    runs = placed.mapInPandas(_stretches, f"month INT, file STRING, at BIGINT, rows BIGINT, {ends}, broken BIGINT")
    last = F.lag(F.struct("last_zone", "last_time")).over(Window.partitionBy("file").orderBy("at"))
    seam = F.coalesce((last > F.struct(c("first_zone").alias("last_zone"), c("first_time").alias("last_time"))).cast("bigint"), F.lit(0))
    return runs.withColumn("broken", c("broken") + seam).groupBy(c("month").alias(PARTITION)).agg(
        F.sum("rows").alias("rows"), F.sum("broken").alias("out_of_order")
    )
