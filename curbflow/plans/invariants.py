"""Statements that must hold between marts and silver; one row per comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbflow.functions.fixed import cents, ratio

c = F.col


def _matched(left: DataFrame, right: DataFrame, a: str, b: str, holds: Column) -> DataFrame:
    both = left.join(right, "month", "full_outer").select(
        "month", F.coalesce(a, F.lit(0)).alias(a), F.coalesce(b, F.lit(0)).alias(b)
    )
    return both.withColumn("holds", holds)


def segment_total(segments: DataFrame, measures: DataFrame) -> DataFrame:
    """Segments are mutually exclusive: their trips add up to all silver trips."""
    left = segments.groupBy("month").agg(F.sum("trips").alias("segment_trips"))
    right = measures.groupBy("month").agg(F.count(F.lit(1)).alias("silver_trips"))
    return _matched(left, right, "segment_trips", "silver_trips",
                    c("segment_trips") == c("silver_trips"))


def histogram_total(histogram: DataFrame, overview: DataFrame) -> DataFrame:
    """Histogram counts add up to trips with a valid wait, never above all trips."""
    left = histogram.groupBy("month").agg(F.sum("trips_with_wait").alias("histogram_trips"))
    right = overview.groupBy(F.trunc("trip_date", "MM").alias("month")).agg(
        F.sum("trips_with_wait").alias("trips_with_wait"), F.sum("trips").alias("trips")
    )
    both = left.join(right, "month", "full_outer")
    return both.withColumn(
        "holds",
        (c("histogram_trips") == c("trips_with_wait")) & (c("histogram_trips") <= c("trips")),
    )


PRICE_PARTS = ["avg_base_fare", "avg_tax", "avg_congestion", "avg_airport_fee", "avg_toll", "avg_bcf"]


def price_components(pricing: DataFrame) -> DataFrame:
    """Mean components add up to the mean total, within their rounding."""
    parts = sum((cents(p) for p in PRICE_PARTS[1:]), cents(PRICE_PARTS[0]))
    # each of the seven figures is off by at most half a cent
    gap = parts - cents("avg_total_fare")
    return pricing.select(
        "trip_date", "operator", parts.alias("parts_cents"),
        cents("avg_total_fare").alias("total_cents"), (F.abs(gap) <= 3).alias("holds"),
    )


def shared_split(daily: DataFrame) -> DataFrame:
    """Actual shared (and WAV) trips = matched requests + matches without request."""
    return daily.select(
        "trip_date", "operator", "actual_shared_trips", "actual_wav_trips",
        (
            (c("actual_shared_trips") == c("shared_requested_matches") + c("shared_orphan_matches"))
            & (c("actual_wav_trips") == c("wav_requested_matches") + c("wav_unrequested_matches"))
        ).alias("holds"),
    )


def airport_share(airports: DataFrame, measures: DataFrame) -> DataFrame:
    """Published percentages are those of totals counted again from the trips."""
    totals = measures.groupBy("month", "operator").agg(F.count(F.lit(1)).alias("of_operator")).withColumn(
        "of_month", F.sum("of_operator").over(Window.partitionBy("month"))
    )
    return airports.join(totals, ["month", "operator"], "left").select(
        "month", "airport", "direction", "operator", "trips",
        F.coalesce(
            (F.abs(c("airport_share_all_trips_pct") - 100.0 * c("trips") / c("of_month")) <= 0.00005001)
            & (F.abs(c("airport_share_operator_trips_pct") - 100.0 * c("trips") / c("of_operator")) <= 0.00005001),
            F.lit(False),
        ).alias("holds"),
    )


def month_totals(airports: DataFrame, measures: DataFrame) -> DataFrame:
    """The month total repeated beside airports is the silver count of the month."""
    left = airports.groupBy("month").agg(
        F.min("all_trips_month").alias("least"), F.max("all_trips_month").alias("all_trips_month")
    )
    right = measures.groupBy("month").agg(F.count(F.lit(1)).alias("silver_trips"))
    same = (c("least") == c("all_trips_month")) & (c("all_trips_month") == c("silver_trips"))
    return left.join(right, "month", "full").select(
        "month", "all_trips_month", "silver_trips", F.coalesce(same, F.lit(False)).alias("holds"),
    )
