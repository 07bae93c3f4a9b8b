"""Profiles, gates and the check list on hand-made rows."""

import tempfile

import pytest
from pyspark.sql import functions as F
from rows import PLAIN, at, bronze, source, trip

from curbflow.contract import COLUMNS, SOURCE_SCHEMA, TRIP_SCHEMA, month_key
from curbflow.operators import contract_checks, profile, quality
from curbflow.sources import clock


def files(spark, rows):
    month = F.coalesce(month_key(F.col("pickup_datetime")), F.lit(202506))
    return source(spark, rows).withColumn("file_month", month)


def scratch():
    return tempfile.mkdtemp(prefix="run-")


def hits(spark, rows):
    return {r.check_name: r.rows_affected
            for r in quality.count_checks(bronze(spark, rows)).collect() if r.rows_affected}


def test_columns():
    assert contract_checks.require_columns(COLUMNS) is True
    assert contract_checks.require_columns(COLUMNS[::-1]) is False
    with pytest.raises(contract_checks.ContractError, match="missing: tips; extra: surprise"):
        contract_checks.require_columns([c for c in COLUMNS if c != "tips"] + ["surprise"])


def test_types(spark):
    assert contract_checks.require_types(TRIP_SCHEMA)
    assert not contract_checks.require_types(SOURCE_SCHEMA, migrate=True)
    with pytest.raises(contract_checks.ContractError, match="shared_request_flag"):
        contract_checks.require_types(SOURCE_SCHEMA)
    states = contract_checks.type_drift(spark, SOURCE_SCHEMA).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in states} == {"ok": 20, "type": 5}


def test_null_profile_and_gate(spark):
    rows = [trip(), trip(originating_base_num=None), trip(tips=None), dict.fromkeys(PLAIN)]
    src = files(spark, rows)
    nulls = {r.column_name: r for r in profile.null_profile(profile.assessed(src, scratch())).collect()}
    assert (nulls["tips"].null_count, nulls["tips"].expected) == (2, False)
    assert (nulls["originating_base_num"].null_count, nulls["originating_base_num"].expected) == (2, True)
    assert nulls["tips"].null_pct == 50.0
    verdicts = {r.check_name: (r.rows_affected, r.verdict) for r in profile.gate(profile.assessed(src, scratch())).collect()}
    assert verdicts == {"unexpected_nulls": (24, "fail"), "empty_rows": (1, "fail"),
                        "duplicate_rows": (0, "pass")}
    with pytest.raises(profile.GateError):
        profile.require(profile.assessed(src, scratch()))


def test_duplicates_with_nulls_are_exact_and_only_warn(spark):
    twin = trip(originating_base_num=None)
    rows = [twin, twin, twin, trip(), trip(tips=1.0)]
    src = files(spark, rows)
    r = profile.duplicate_rows(profile.assessed(src, scratch())).collect()[0]
    assert (r.rows, r.duplicate_rows) == (5, 2)
    assert profile.require(profile.assessed(src, scratch())) == ["202506: duplicate_rows 2"]


def test_one_row_repeated_in_a_third_of_the_file(spark):
    many = spark.range(30_000).select(
        *[F.lit(PLAIN[c]).cast(SOURCE_SCHEMA[c].dataType).alias(c) if c != "trip_time"
          else F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10).alias(c) for c in COLUMNS]
    ).withColumn("file_month", F.lit(202506))
    assert profile.duplicate_rows(profile.assessed(many, scratch())).collect()[0].duplicate_rows == 9_999




def test_counts_of_severities(spark):
    found = [c.severity for c in quality.checks()]
    assert (len(found), found.count("error"), found.count("warning"), found.count("info")) == (43, 12, 15, 16)
    assert len({c.name for c in quality.checks()}) == 43


@pytest.mark.parametrize("row, name", [
    (trip(PULocationID=0), "PULocationID вне 1-265"),
    (trip(DOLocationID=266), "DOLocationID вне 1-265"),
    (trip(PULocationID=264), "PULocationID = 264 (Unknown)"),
    (trip(DOLocationID=265), "DOLocationID = 265 (Outside of NYC)"),
    (trip(DOLocationID=10), "посадка и высадка в одной зоне"),
    (trip(trip_miles=-1.0), "trip_miles < 0"),
    (trip(trip_miles=60.0), "скорость > 100 миль/ч"),
    (trip(tips=-0.01), "tips < 0"),
    (trip(cbd_congestion_fee=1.5, congestion_surcharge=2.75), "congestion_surcharge и cbd одновременно"),
    (trip(wav_request_flag="Y"), "wav_request без wav_match"),
    (trip(shared_match_flag="Y"), "orphan_matches"),
    (trip(-3), "pickup_datetime < request_datetime"),
    (trip(trip_time=1000), "|trip_time - факт| > 60 с, не DST"),
])
def test_single_checks(spark, row, name):
    assert hits(spark, [trip(), row]) == {name: 1}


def test_clock_changes(spark):
    fall = trip(request_datetime=at("2025-11-02 01:25:00"), pickup_datetime=at("2025-11-02 01:30:00"),
                dropoff_datetime=at("2025-11-02 01:10:00"), trip_time=2400)
    assert hits(spark, [fall]) == {
        "DST fall-back: dropoff < pickup": 1, "DST fall-back: duration_diff ≈ +3600": 1,
        "час 01 в ночь возврата на зимнее время": 1,
    }
    spring = trip(request_datetime=at("2025-03-09 01:40:00"), pickup_datetime=at("2025-03-09 01:50:00"),
                  dropoff_datetime=at("2025-03-09 03:10:00"), trip_time=1200)
    assert hits(spark, [spring]) == {"DST spring-forward: duration_diff ≈ -3600": 1}
    missing = trip(request_datetime=at("2026-03-08 02:10:00"), pickup_datetime=at("2026-03-08 02:30:00"),
                   dropoff_datetime=at("2026-03-08 03:10:00"), trip_time=2400)
    assert hits(spark, [missing]) == {
        "DST spring-forward: request в несуществующем 02:xx": 1,
        "DST spring-forward: pickup в несуществующем 02:xx": 1,
    }


def test_error_stops_the_build(spark):
    good = quality.all_checks(bronze(spark, [trip(), trip(-3)]))
    quality.require(good)
    assert quality.verdict(good).collect()[0].build_allowed
    bad = quality.all_checks(bronze(spark, [trip(tolls=-1.0)]))
    assert not quality.verdict(bad).collect()[0].build_allowed
    with pytest.raises(quality.QualityError, match="tolls < 0: 1"):
        quality.require(bad)


def test_maxima_are_plain_text(spark):
    rows = quality.max_checks(bronze(spark, [trip(), trip(base_passenger_fare=12345678.5)])).collect()
    notes = {r.check_name: r.note for r in rows}
    assert notes["max(base_passenger_fare)"] == "12345678.5"
    assert notes["max(trip_time)"] == "1200" and len(notes) == 11


def test_partition_anomalies_of_an_all_clean_month(spark):
    rows = bronze(spark, [trip(), trip(base_passenger_fare=-1.0)]).withColumn("pickup_month", F.lit(202506))
    got = {r.metric_name: (r.rows_affected, r.share_pct, r.action_taken)
           for r in quality.partition_anomalies(rows).collect()}
    assert len(got) == 9
    assert got["negative fare"] == (1, 50.0, "flagged") == got["fare <= 0"]
    assert got["on_scene is null"] == (0, 0.0, "retained")


def test_clock_changes_of_other_years_need_no_dates(spark):
    """Changes come from time zone data: those of 2028 are found once the window covers them."""
    rows = [
        trip(pickup_datetime=at("2028-03-12 01:50:00"), dropoff_datetime=at("2028-03-12 03:10:00"), trip_time=1200),
        trip(pickup_datetime=at("2028-11-05 01:50:00"), dropoff_datetime=at("2028-11-05 01:10:00"), trip_time=1200),
        trip(pickup_datetime=at("2028-03-12 02:30:00"), request_datetime=at("2028-03-12 02:20:00"), dropoff_datetime=at("2028-03-12 03:00:00")),
        trip(pickup_datetime=at("2028-03-19 02:30:00"), request_datetime=at("2028-03-19 02:20:00"), dropoff_datetime=at("2028-03-19 03:00:00")),
    ]
    found = bronze(spark, rows).agg(*[F.count_if(c).alias(k) for k, c in quality.dst_flags(("2028-01-01", "2029-01-01")).items()]).first()
    assert found.asDict() == {"spring_duration": 1, "fall_duration": 1, "request_in_gap": 1, "pickup_in_gap": 1, "repeated_hour": 1}
    none = bronze(spark, rows).agg(*[F.count_if(c).alias(k) for k, c in quality.dst_flags().items()]).first()
    assert set(none.asDict().values()) == {0}
    shifts = {r.day.isoformat(): r.shift_seconds for r in clock.transitions(spark, first="2025-01-01", last="2026-12-31").collect()}
    assert shifts == {"2025-03-09": 3600, "2025-11-02": -3600, "2026-03-08": 3600, "2026-11-01": -3600}
    assert clock.transitions(spark, "Europe/Berlin", "2025-01-01", "2025-12-31").count() == 2
    assert clock.transitions(spark, "UTC").isEmpty()
