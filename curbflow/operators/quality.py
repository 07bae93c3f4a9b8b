"""Checks on the bronze table: per-month anomalies and the graded check list.

All checks are booleans on a row, so any number of them costs one scan: one
aggregate per table, then the counters are turned into rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.contract import PARTITION
from curbflow.functions import trip as t
from curbflow.functions.fixed import plain_number, ratio
from curbflow.sources import clock

c = F.col

# The covered window, and thresholds.
WINDOW = ("2025-01-01", "2026-05-01")
CBD_FEE_START = "2025-01-05"
DURATION_TOLERANCE = 60
ZONE_IDS = (1, 265)
UNKNOWN_ZONE, OUTSIDE_ZONE = 264, 265
LONG_TRIP_MILES = 100
LONG_TRIP_SECONDS = 6 * 3600
SHORT_TRIP_SECONDS = 10
HOUR = 3600


class QualityError(RuntimeError):
    """A check of severity 'error' found rows; gold tables must not be rebuilt."""


@dataclass(frozen=True)
class Check:
    group: str
    name: str
    severity: str
    rows: Column
    note: str


def _at(day: str, hours: int = 0) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{day} 00:00:00' + INTERVAL '{hours}' HOUR")


def dst_flags(window: tuple[str, str] = WINDOW) -> dict[str, Column]:
    """Clock-change artefacts of a trip, by name, for the changes within the covered window.

    Trips outside of it are errors of their own. The days come from time zone data, so another window needs no other
    dates; they are few, and stand in the compiled code: as a join of three dates they took twice as long.
    """
    first, last = (dt.date.fromisoformat(x) for x in window)
    changes = {s: [d for d in days if first <= d <= last] for s, days in clock.days().items()}
    diff = t.duration_diff()

    def on(shift: int, name: str) -> Column:
        return F.to_date(f"{name}_datetime").isin(*changes[shift])

    back = on(-HOUR, "pickup")
    # picked up the day before or before the gap, dropped off after it on the day itself
    into = on(HOUR, "dropoff") & (F.hour("dropoff_datetime") >= 3)
    day_before = F.to_date("pickup_datetime") == F.date_sub(F.to_date("dropoff_datetime"), 1)
    same_day = (F.to_date("pickup_datetime") == F.to_date("dropoff_datetime")) & (F.hour("pickup_datetime") < 2)
    return {
        "spring_duration": into & (day_before | same_day) & (F.abs(diff + HOUR) <= DURATION_TOLERANCE),
        "fall_duration": back & (F.abs(diff - HOUR) <= DURATION_TOLERANCE),
        "request_in_gap": on(HOUR, "request") & (F.hour("request_datetime") == 2),
        "pickup_in_gap": on(HOUR, "pickup") & (F.hour("pickup_datetime") == 2),
        "repeated_hour": back & (F.hour("pickup_datetime") == 1),
    }


def checks() -> list[Check]:
    """The graded list. Names and severities are fixed values of the check table."""
    out: list[Check] = []

    def add(group: str, name: str, severity: str, rows: Column, note: str) -> None:
        out.append(Check(group, name, severity, rows, note))

    start, end = c("PULocationID"), c("DOLocationID")
    known, service = "the zone lookup has exactly these ids", "service zone; keep the trip, leave it out of maps only"
    add("zones", "PULocationID вне 1-265", "error", ~start.between(*ZONE_IDS), known)
    add("zones", "DOLocationID вне 1-265", "error", ~end.between(*ZONE_IDS), known)
    add("zones", "PULocationID = 264 (Unknown)", "info", start == UNKNOWN_ZONE, service)
    add("zones", "DOLocationID = 264 (Unknown)", "info", end == UNKNOWN_ZONE, service)
    add("zones", "PULocationID = 265 (Outside of NYC)", "info", start == OUTSIDE_ZONE, service)
    add("zones", "DOLocationID = 265 (Outside of NYC)", "info", end == OUTSIDE_ZONE, service)
    add("zones", "посадка и высадка в одной зоне", "info", start == end, "short trips inside one zone are normal")

    miles, secs = c("trip_miles"), c("trip_time")
    add("geo", "trip_miles < 0", "error", miles < 0, "cannot be negative")
    add("geo", "trip_time < 0", "error", secs < 0, "cannot be negative")
    add("geo", "trip_miles = 0", "warning", miles == 0, "no ride; removed by the silver filter")
    add("geo", "trip_miles > 100", "info", miles > LONG_TRIP_MILES, "long-distance trips are real")
    add("geo", "скорость > 100 миль/ч", "warning", (secs > 0) & t.too_fast(),
        "broken odometer; removed by the silver filter")

    pickup, dropoff, request = c("pickup_datetime"), c("dropoff_datetime"), c("request_datetime")
    dst = dst_flags()
    add("time", "DST fall-back: dropoff < pickup", "info",
        (dropoff < pickup) & dst["fall_duration"], "the hour lived twice; metered time confirms it")
    add("time", "dropoff < pickup, не объяснён DST", "warning",
        (dropoff < pickup) & ~dst["fall_duration"], "no clock change explains it")
    add("time", "dropoff_datetime = pickup_datetime", "warning", dropoff == pickup,
        "no duration by the time stamps")
    add("time", "pickup_datetime < request_datetime", "warning", pickup < request,
        "mostly scheduled rides: the request time is the appointed time")
    add("time", "час 01 в ночь возврата на зимнее время", "info", dst["repeated_hour"],
        "local hour lived twice; hourly figures of that date are too high")
    add("time", "DST spring-forward: request в несуществующем 02:xx", "warning",
        dst["request_in_gap"], "this local hour did not exist")
    add("time", "DST spring-forward: pickup в несуществующем 02:xx", "warning",
        dst["pickup_in_gap"], "this local hour did not exist")
    add("time", "DST spring-forward: duration_diff ≈ -3600", "info", dst["spring_duration"],
        "the trip crossed the missing hour")
    add("time", "DST fall-back: duration_diff ≈ +3600", "info", dst["fall_duration"],
        "the repeated hour shortens the stamp difference")
    add("time", "trip_time < 10 секунд", "warning", secs < SHORT_TRIP_SECONDS,
        "removed by the silver filter")
    add("time", "trip_time > 6 часов", "warning", secs > LONG_TRIP_SECONDS, "unusually long")
    add("time", "|trip_time - факт| > 60 с, не DST", "warning",
        (F.abs(t.duration_diff()) > DURATION_TOLERANCE)
        & ~(dst["spring_duration"] | dst["fall_duration"]),
        "metered and stamped duration differ without a clock change")
    add("time", "pickup вне окна 2025-01..2026-04", "error",
        (pickup < _at(WINDOW[0])) | (pickup >= _at(WINDOW[1])), "partitioning must exclude it")
    add("time", "request раньше окна", "info", request < _at(WINDOW[0]),
        "ordered before midnight of the first day")
    add("time", "dropoff позже окна", "info", dropoff >= _at(WINDOW[1]),
        "ended after midnight of the last day")

    reversal, never = "reversals and corrections; removed by the silver filter", "cannot be negative"
    add("money", "base_passenger_fare < 0", "warning", c("base_passenger_fare") < 0, reversal)
    add("money", "driver_pay < 0", "warning", c("driver_pay") < 0, reversal)
    add("money", "tips < 0", "error", c("tips") < 0, never)
    add("money", "tolls < 0", "error", c("tolls") < 0, never)
    add("money", "bcf < 0", "error", c("bcf") < 0, never)
    add("money", "sales_tax < 0", "error", c("sales_tax") < 0, never)
    add("money", "congestion_surcharge < 0", "error", c("congestion_surcharge") < 0, never)
    add("money", "airport_fee < 0", "error", c("airport_fee") < 0, never)
    add("money", "cbd_congestion_fee < 0", "error", c("cbd_congestion_fee") < 0, never)
    add("money", "base_passenger_fare = 0", "warning", c("base_passenger_fare") == 0,
        "removed by the silver filter")
    cbd = c("cbd_congestion_fee")
    add("money", "cbd_congestion_fee до 05.01.2025", "info",
        (cbd != 0) & (pickup < _at(CBD_FEE_START)), "ended after the fee began")
    add("money", "congestion_surcharge и cbd одновременно", "info",
        (c("congestion_surcharge") > 0) & (cbd > 0), "two programmes that may both apply")

    wav_asked, wav_sent = t.flag("wav_request_flag"), t.flag("wav_match_flag")
    add("flags", "wav_request без wav_match", "warning", wav_asked & ~wav_sent,
        "asked for an accessible car, none came")
    add("flags", "wav_match без wav_request", "info", ~wav_asked & wav_sent,
        "accessible car on a normal order")
    add("flags", "orphan_matches", "warning",
        ~t.flag("shared_request_flag") & t.flag("shared_match_flag"),
        "shared without a request; outside match rates")
    add("flags", "wav_request и access_a_ride вместе", "info",
        wav_asked & t.flag("access_a_ride_flag"), "independent flags")
    return out


MAXIMA = [
    "base_passenger_fare", "driver_pay", "tips", "tolls", "congestion_surcharge", "bcf",
    "airport_fee", "sales_tax", "cbd_congestion_fee", "trip_miles", "trip_time",
]


def _scan(trips: DataFrame) -> DataFrame:
    """The single aggregate behind all checks and maxima."""
    return trips.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(k.rows).alias(f"c{i}") for i, k in enumerate(checks())],
        *[F.max(m).alias(f"max_{m}") for m in MAXIMA],
    )


def _row(group: str, name: str, hits: Column, severity: str, note: Column) -> Column:
    return F.struct(
        F.lit(group).alias("check_group"), F.lit(name).alias("check_name"),
        hits.alias("rows_affected"), F.lit(severity).alias("severity"), note.alias("note"),
    )


def all_checks(trips: DataFrame) -> DataFrame:
    """Counts and maxima as rows of the check table, from one scan.

    A maximum carries its value as the note, so drift shows from run to run.
    """
    none = F.lit(0).cast("bigint")
    rows = [
        _row(k.group, k.name, c(f"c{i}"), k.severity, F.lit(k.note))
        for i, k in enumerate(checks())
    ] + [
        _row("maxima", f"max({m})", none, "info", plain_number(c(f"max_{m}"))) for m in MAXIMA
    ]
    return _scan(trips).select("total", F.explode(F.array(*rows)).alias("k")).select(
        "k.check_group", "k.check_name", "k.rows_affected",
        F.coalesce(ratio("k.rows_affected", "total", 6, times=100), F.lit(0.0)).alias("share_pct"),
        "k.severity", "k.note",
    )


def count_checks(trips: DataFrame) -> DataFrame:
    return all_checks(trips).where(c("check_group") != "maxima")


def max_checks(trips: DataFrame) -> DataFrame:
    return all_checks(trips).where(c("check_group") == "maxima")


def verdict(results: DataFrame) -> DataFrame:
    """Hit checks per severity and whether gold may be built."""
    hit = F.count_if(c("rows_affected") > 0)
    by = {s: F.count_if((c("severity") == s) & (c("rows_affected") > 0)) for s in ("error", "warning")}
    counted = results.where(c("check_group") != "maxima")
    return counted.agg(
        F.count(F.lit(1)).alias("checks"), hit.alias("checks_hit"),
        by["error"].alias("errors"), by["warning"].alias("warnings"),
        (by["error"] == 0).alias("build_allowed"),
    )


def require(results: DataFrame) -> None:
    """Raise when an error check found rows (at most a few dozen rows collected)."""
    bad = results.where("severity = 'error' AND rows_affected > 0").collect()
    if bad:
        raise QualityError("; ".join(f"{r.check_name}: {r.rows_affected}" for r in bad))


def partition_anomalies(trips: DataFrame) -> DataFrame:
    """Nine anomaly counters of every month, as rows of the anomaly table."""
    fare, miles = c("base_passenger_fare"), c("trip_miles")
    # Metric names and the action recorded for each.
    metrics = [
        ("negative fare", fare < 0, "flagged"),
        ("fare <= 0", fare <= 0, "flagged"),
        ("trip_miles = 0", miles == 0, "flagged"),
        ("trip_miles > 100", miles > LONG_TRIP_MILES, "retained"),
        ("trip_time > 6h", c("trip_time") > LONG_TRIP_SECONDS, "flagged"),
        ("dropoff <= pickup", ~t.duration_valid(), "flagged"),
        ("pickup < request", c("pickup_datetime") < c("request_datetime"), "retained"),
        ("service zones 264/265",
         (c("PULocationID") >= UNKNOWN_ZONE) | (c("DOLocationID") >= UNKNOWN_ZONE), "retained"),
        ("on_scene is null", c("on_scene_datetime").isNull(), "retained"),
    ]
    wide = trips.groupBy(c(PARTITION).alias("partition_id")).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(cond).alias(f"m{i}") for i, (_, cond, _) in enumerate(metrics)],
    )
    structs = [
        F.struct(F.lit(name).alias("metric_name"), c(f"m{i}").alias("rows_affected"),
                 F.lit(action).alias("action_taken"))
        for i, (name, _, action) in enumerate(metrics)
    ]
    return wide.select("partition_id", "total", F.explode(F.array(*structs)).alias("m")).select(
        "partition_id", "m.metric_name", "m.rows_affected",
        F.coalesce(ratio("m.rows_affected", "total", 4, times=100), F.lit(0.0)).alias("share_pct"),
        "m.action_taken",
    )
