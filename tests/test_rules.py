"""Boundary rows for the row rules and marts."""

import datetime as dt

import pytest
from rows import at, bronze, trip, zones

from curbflow.functions import fixed
from curbflow.functions import trip as t
from curbflow.plans import marts
from pyspark.sql import functions as F


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


@pytest.mark.parametrize("changes, kept", [
    ({}, True), ({"trip_time": 29}, False), ({"trip_time": 30, "trip_miles": 0.5}, True),
    ({"trip_miles": 0.0}, False), ({"base_passenger_fare": 0.0}, False),
    ({"base_passenger_fare": -3.0}, False), ({"driver_pay": 0.0}, False),
    ({"trip_miles": 10.0, "trip_time": 360}, True),  # exactly 100 mph
    ({"trip_miles": 10.001, "trip_time": 360}, False),
    ({"trip_miles": 571.0, "trip_time": 37080}, True), ({"trip_time": 0}, False),
])
def test_silver(spark, changes, kept):
    assert (t.silver(bronze(spark, [trip(**changes)])).count() == 1) is kept


def test_wait_boundaries(spark):
    waits = [-1, 0, 600, 601, 900, 901, 7200, 7201]
    r = one(marts.build("mart_hourly_pattern", bronze(spark, [trip(w) for w in waits]), zones(spark)))
    assert (r.trips, r.scheduled_rides, r.trips_with_wait) == (8, 1, 6)
    assert (r.trips_wait_gt10, r.trips_wait_gt15) == (4, 2)
    assert r.share_wait_gt10 == 0.6667
    assert r.wait_p50 == 750.5
    assert r.day_of_week == 1  # Monday


def test_no_valid_wait_gives_null(spark):
    r = one(marts.build("mart_overview_daily", bronze(spark, [trip(-5), trip(9000)]), zones(spark)))
    assert (r.trips_with_wait, r.wait_p50, r.wait_p90) == (0, None, None)
    assert r.avg_speed_mph == 15.0


def test_trip_belongs_to_pickup_day(spark):
    late = trip(pickup_datetime=at("2025-06-30 23:59:59"), dropoff_datetime=at("2025-07-01 00:20:00"))
    r = one(marts.build("mart_overview_daily", bronze(spark, [late]), zones(spark)))
    assert r.trip_date == dt.date(2025, 6, 30)


def test_buckets(spark):
    waits = [0, 29, 30, 599, 600, 1799, 1800, 7200]
    df = bronze(spark, [trip(w) for w in waits])
    uneven = {r.bucket_order: r for r in marts.build("mart_wait_histogram", df, zones(spark)).collect()}
    assert {k: v.trips_with_wait for k, v in uneven.items()} == {1: 2, 2: 1, 9: 1, 10: 1, 13: 1, 14: 2}
    assert uneven[10].wait_bucket == "10-15 мин" and uneven[14].wait_bucket == "30+ мин"
    minute = {r.bucket_order: r for r in
              marts.build("mart_wait_histogram_minute", df, zones(spark)).collect()}
    assert minute[1].wait_bucket == "0-1 мин" and minute[16].wait_bucket == "15+ мин"
    assert minute[16].trips_with_wait == 3


def test_mile_bins(spark):
    rows = [trip(trip_miles=m, trip_time=9000) for m in (0.4, 1.0, 59.999, 60.0, 200.0)]
    got = {r.distance_bin_miles: r.trips
           for r in marts.build("mart_fare_distance", bronze(spark, rows), zones(spark)).collect()}
    assert got == {0: 1, 1: 1, 59: 1, 60: 2}


def test_segments_and_unknown_zone(spark):
    ends = [(10, 132), (1, 20), (10, 20), (20, 10), (10, 30), (10, 999)]
    df = bronze(spark, [trip(PULocationID=a, DOLocationID=b) for a, b in ends])
    got = {r.segment: r.trips
           for r in marts.build("mart_economics_segment", df, zones(spark)).collect()}
    assert got == {"Airport": 2, "Manhattan": 2, "Regular": 2}


def test_routes_merge_zones_of_one_name(spark):
    df = bronze(spark, [trip(PULocationID=30), trip(PULocationID=31)])
    r = one(marts.build("mart_routes", df, zones(spark)))
    assert (r.pu_zone_name, r.trips) == ("Same", 2)
    assert marts.build("mart_pickup_zones", df, zones(spark)).count() == 2


def test_airport_to_airport_counts_twice(spark):
    df = bronze(spark, [trip(PULocationID=132, DOLocationID=1), trip()])
    rows = {(r.airport, r.direction): r
            for r in marts.build("mart_airports", df, zones(spark)).collect()}
    assert set(rows) == {("JFK", "pickup"), ("Newark", "dropoff")}
    assert rows["JFK", "pickup"].all_trips_month == 2
    assert rows["JFK", "pickup"].airport_share_all_trips_pct == 50.0


def test_operator_else_branch(spark):
    df = bronze(spark, [trip(hvfhs_license_num=x) for x in ("HV0003", "HV0005", "HV0004")])
    assert {r.o for r in df.select(t.operator_name().alias("o")).collect()} == {"Uber", "Lyft", "HV0004"}


def test_total_excludes_tips(spark):
    df = bronze(spark, [trip(tips=7.0, tolls=1.0, cbd_congestion_fee=1.5)])
    assert one(df.select(t.total_fare_cents().alias("x"))).x == 2450


def test_feature_cohorts(spark):
    flags = ["shared_request_flag", "shared_match_flag", "access_a_ride_flag",
             "wav_request_flag", "wav_match_flag"]
    rows = []
    for bits in range(32):
        rows.append(trip(700, **{f: "Y" if bits >> i & 1 else "N" for i, f in enumerate(flags)}))
    r = one(marts.build("mart_shared_wav_daily", bronze(spark, rows), zones(spark)))
    assert (r.trips, r.shared_requests, r.shared_requested_matches) == (32, 16, 8)
    assert r.shared_orphan_matches + r.shared_requested_matches == r.actual_shared_trips == 16
    assert (r.regular_trips_with_wait, r.regular_sum_wait_sec, r.regular_wait_gt10) == (1, 700, 1)
    assert (r.aar_trips_with_wait, r.aar_wait_gt15) == (16, 0)
    assert r.access_a_ride_wav_requested_matches == 4
    assert r.shared_match_rate == 0.5


def test_no_request_gives_null_rate(spark):
    r = one(marts.build("mart_shared_wav_daily", bronze(spark, [trip()]), zones(spark)))
    assert r.shared_match_rate is None and r.shared_request_rate == 0.0


@pytest.mark.parametrize("num, den, digits, unit, want", [
    (5, 2, 0, 1, 2.0), (7, 2, 0, 1, 4.0), (-5, 2, 0, 1, -2.0), (1, 3, 4, 1, 0.3333),
    (2, 3, 4, 1, 0.6667), (12345, 100, 1, 1, 123.4), (1, 0, 2, 1, None),
    (10**17, 3, 2, 10**4, 3333333333333.33), (1005, 1, 2, 1000, 1.0), (1015, 1, 2, 1000, 1.02),
])
def test_ratio_rounds_half_to_even(spark, num, den, digits, unit, want):
    df = spark.createDataFrame([(num, den)], "n BIGINT, d BIGINT")
    assert one(df.select(fixed.ratio("n", "d", digits, unit=unit).alias("x"))).x == want


def test_waits_do_not_depend_on_the_session_zone(spark):
    rows = [trip(request_datetime=at("2025-03-09 01:50:00"), pickup_datetime=at("2025-03-09 02:30:00"))]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = bronze(spark, rows)
        assert one(df.select(t.wait_seconds().alias("x"), F.hour("pickup_datetime").alias("h"))) == (2400, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
