"""Hand-made trips: a plain valid trip, changed column by column."""

from __future__ import annotations

import datetime as dt

from curbflow.contract import COLUMNS, SOURCE_SCHEMA, to_bronze


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


PLAIN = {
    "hvfhs_license_num": "HV0003", "dispatching_base_num": "B1", "originating_base_num": "B1",
    "request_datetime": at("2025-06-02 10:00:00"), "on_scene_datetime": at("2025-06-02 10:04:00"),
    "pickup_datetime": at("2025-06-02 10:05:00"), "dropoff_datetime": at("2025-06-02 10:25:00"),
    "PULocationID": 10, "DOLocationID": 20, "trip_miles": 5.0, "trip_time": 1200,
    "base_passenger_fare": 20.0, "tolls": 0.0, "bcf": 0.5, "sales_tax": 1.5,
    "congestion_surcharge": 0.0, "airport_fee": 0.0, "tips": 0.0, "driver_pay": 15.0,
    "shared_request_flag": "N", "shared_match_flag": "N", "access_a_ride_flag": "N",
    "wav_request_flag": "N", "wav_match_flag": "N", "cbd_congestion_fee": 0.0,
}


def trip(wait: int | None = None, **changes) -> dict:
    row = PLAIN | changes
    if wait is not None:
        row["request_datetime"] = row["pickup_datetime"] - dt.timedelta(seconds=wait)
    return row


def source(spark, rows: list[dict]):
    return spark.createDataFrame([tuple(r[x] for x in COLUMNS) for r in rows], SOURCE_SCHEMA)


def bronze(spark, rows: list[dict]):
    return to_bronze(source(spark, rows))


def zones(spark):
    return spark.createDataFrame(
        [(10, "Queens", "Ten", "Boro Zone"), (20, "Manhattan", "Twenty", "Yellow Zone"),
         (30, "Bronx", "Same", "Boro Zone"), (31, "Bronx", "Same", "Boro Zone"),
         (1, "EWR", "Newark Airport", "EWR"), (132, "Queens", "JFK Airport", "Airports")],
        "location_id INT, borough STRING, zone STRING, service_zone STRING",
    )
