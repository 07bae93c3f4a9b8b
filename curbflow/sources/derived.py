"""Trip-shaped rows derived from the order-line table, and zones from nations.

Raw trip files are not available where the queries are checked. These narrow
projections give every trip rule something to act on: they add no shuffle, and
only the columns a query asks for are computed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.contract import COLUMNS, month_key, to_bronze
from curbflow.functions import trip as t

WINDOW_START = "2025-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _later(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("int"), ts)


def _yes(cond: Column) -> Column:
    return F.when(cond, "Y").otherwise("N")


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of ``lineitem`` with what their trips are made from: a few plain columns, and where a trip belongs.

    Whatever has to bring rows into an order moves these; :func:`made` turns them into trips where they lie then.
    """
    c = F.col
    h = c("h")
    seeded = table(spark, sf_dir, "lineitem").withColumns(
        {
            "h": c("l_orderkey") * 7919 + c("l_partkey") * 104729
            + c("l_suppkey") * 611953 + c("l_linenumber").cast("bigint") * 1299709,
            "price": F.floor("l_extendedprice").cast("bigint"),
        }
    )
    return seeded.select(
        "h", "l_suppkey", "l_discount", "l_tax", (c("l_returnflag") == "R").alias("returned"),
        F.when(c("l_linenumber") > 5, _dollars(c("l_quantity").cast("bigint") * 20)).otherwise(0.0).alias("tips"),
        F.when(h % 3001 == 0, F.lit(0).cast("bigint")).otherwise(300 + c("price") % 9000).alias("base_cents"),
        (1 + (c("l_suppkey") * 37 + c("l_orderkey")) % 265).cast("int").alias("PULocationID"),
        _pickup().alias("pickup_datetime"),
    )


def _dollars(cents: Column) -> Column:
    return cents.cast("double") / 100.0


def _pickup() -> Column:
    return _later(F.expr(f"TIMESTAMP_NTZ'{WINDOW_START}'"), F.col("h") % 41904000)


def _trip_time() -> Column:
    return 20 + (F.col("h") * 17) % 9000


def source_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of ``lineitem`` as trips in month-file form (flags 'Y'/'N')."""
    return made(seeds(spark, sf_dir))


def made(seeds: DataFrame, *beside: str) -> DataFrame:
    """The trips of :func:`seeds` in month-file form, row by row, with the columns ``beside`` of the seeds."""
    c = F.col
    h = c("h")
    start = F.expr(f"TIMESTAMP_NTZ'{WINDOW_START}'")

    core = seeds.withColumns(
        {
            "trip_time": _trip_time(),
            "w": F.when(h % 83 == 0, -1 - h % 900)
            .when(h % 997 == 0, 7201 + h % 5000)
            .otherwise((h * 31) % 1499),
            "hvfhs_license_num": F.when(h % 10007 == 0, "HV0004")
            .when(c("returned"), "HV0005")
            .otherwise("HV0003"),
            "DOLocationID": (1 + (h * 7) % 265).cast("int"),
        }
    )
    lyft = c("hvfhs_license_num") == "HV0005"
    uber = c("hvfhs_license_num") == "HV0003"
    base = c("base_cents")
    speed = F.when(h % 4001 == 0, F.lit(150).cast("bigint")).otherwise(5 + (h * 13) % 25)
    milli = F.when(h % 4999 == 0, F.lit(0).cast("bigint")).otherwise(
        F.floor(c("trip_time") * speed * 1000 / 3600).cast("bigint")
    )
    cbd_start = _later(start, F.lit(345600))

    def whole(x: Column) -> Column:
        # non-negative quotients far below 2^53, so floor of the double is exact
        return F.floor(x)

    trips = core.select(
        "hvfhs_license_num",
        F.concat(F.lit("B"), c("l_suppkey").cast("string")).alias("dispatching_base_num"),
        F.when(~lyft, F.concat(F.lit("B"), c("l_suppkey").cast("string")))
        .alias("originating_base_num"),
        _later(c("pickup_datetime"), -c("w")).alias("request_datetime"),
        F.when(~lyft, _later(c("pickup_datetime"), F.lit(-30))).alias("on_scene_datetime"),
        "pickup_datetime",
        _later(
            c("pickup_datetime"),
            F.when(h % 2003 == 0, c("trip_time") - 3600).otherwise(c("trip_time")),
        ).alias("dropoff_datetime"),
        "PULocationID",
        "DOLocationID",
        (milli.cast("double") / 1000.0).alias("trip_miles"),
        "trip_time",
        _dollars(base).alias("base_passenger_fare"),
        F.when(h % 9 == 0, 6.94).otherwise(0.0).alias("tolls"),
        _dollars(whole(base * 245 / 10000)).alias("bcf"),
        _dollars(whole(base * F.rint(c("l_tax") * 100) / 100)).alias("sales_tax"),
        F.when(h % 2 == 0, 2.75).otherwise(0.0).alias("congestion_surcharge"),
        F.when(c("PULocationID").isin(1, 132, 138), 2.5).otherwise(0.0).alias("airport_fee"),
        "tips",
        _dollars(whole(base * (70 + F.rint(c("l_discount") * 100)) / 100)).alias("driver_pay"),
        _yes(uber & (h % 40 == 0)).alias("shared_request_flag"),
        _yes((uber & (h % 80 == 0)) | (h % 1009 == 0)).alias("shared_match_flag"),
        _yes(h % 300 == 7).alias("access_a_ride_flag"),
        _yes(h % 350 == 7).alias("wav_request_flag"),
        _yes(((h % 350 == 7) & (h % 11 != 0)) | (h % 12 == 5)).alias("wav_match_flag"),
        F.when((h % 3 == 0) & (c("pickup_datetime") >= cbd_start), 1.5)
        .otherwise(0.0).alias("cbd_congestion_fee"),
        *beside,
    )
    return trips.select(*COLUMNS, *beside)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows in bronze form (flags as booleans)."""
    return bronze(seeds(spark, sf_dir))


def bronze(seeds: DataFrame, *beside: str) -> DataFrame:
    """:func:`made` in bronze form."""
    return to_bronze(made(seeds, *beside), *beside)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """265 zones (id, borough, zone, service_zone) from nations and regions."""
    c = F.col
    loc = c("location_id")
    regions = table(spark, sf_dir, "region")
    nations = table(spark, sf_dir, "nation").join(
        regions, c("n_regionkey") == c("r_regionkey"), "left_semi"
    )
    ids = nations.select(
        "n_regionkey",
        F.explode(
            F.transform(F.sequence(F.lit(0), F.lit(10)), lambda k: c("n_nationkey") + 25 * k + 1)
        ).alias("location_id"),
    ).where(loc <= 265)
    same_name = F.when(loc == 57, 56).when(loc.isin(104, 105), 103).otherwise(loc)
    borough = (
        F.when(loc == 1, "EWR").when(loc == 264, "Unknown").when(loc == 265, "N/A")
        .when(c("n_regionkey") == 0, "Manhattan").when(c("n_regionkey") == 1, "Brooklyn")
        .when(c("n_regionkey") == 2, "Queens").when(c("n_regionkey") == 3, "Bronx")
        .otherwise("Staten Island")
    )
    return ids.select(
        "location_id",
        borough.alias("borough"),
        F.concat(F.lit("Zone "), same_name.cast("string")).alias("zone"),
        F.when(loc == 1, "EWR").when(loc >= 264, "N/A").when(c("n_regionkey") == 0, "Yellow Zone")
        .otherwise("Boro Zone").alias("service_zone"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A GeoJSON feature text per customer: grid cells 17 wide, one per zone id.

    Property names vary, one customer in seven has no geometry, one a Point,
    one a MultiPolygon; several customers repeat the outline of a zone.
    """
    c = F.col
    key = c("c_custkey")
    cells = table(spark, sf_dir, "customer").select(
        "c_custkey", (1 + key % 265).alias("id")
    ).select(
        "c_custkey", "id",
        *[
            ((first + step * (of + k)).cast("double") / 100.0).cast("string").alias(f"{axis}{k}")
            for axis, first, step, of in (
                ("x", -7430, 5, (c("id") - 1) % 17),
                ("y", 4050, 4, F.floor((c("id") - 1) / 17)),
            )
            for k in (0, 1)
        ],
    )

    def ring(*corners: str) -> Column:
        points = [F.concat(F.lit("["), c(a), F.lit(","), c(b), F.lit("]"))
                  for a, b in (p.split() for p in corners)]
        return F.concat(F.lit("[["), F.concat_ws(",", *points), F.lit("]]"))

    cell = ring("x0 y0", "x1 y0", "x1 y1", "x0 y1", "x0 y0")
    half = ring("x0 y0", "x1 y0", "x1 y1", "x0 y0")

    def shape(kind: str, coords: Column) -> Column:
        return F.concat(F.lit(f'{{"type":"{kind}","coordinates":'), coords, F.lit("}"))

    geometry = (
        F.when(key % 7 == 0, F.lit("null"))
        .when(key % 7 == 1, shape("MultiPolygon", F.concat(F.lit("["), cell, F.lit(","), half,
                                                           F.lit("]"))))
        .when(key % 7 == 2, shape("Point", F.concat(F.lit("["), c("x0"), F.lit(","), c("y0"),
                                                    F.lit("]"))))
        .otherwise(shape("Polygon", cell))
    )
    id_name = F.when(key % 3 == 0, "LocationID").when(key % 3 == 1, "location_id").otherwise("OBJECTID")
    zone_name = F.when(key % 2 == 0, "zone").otherwise("Zone_Name")
    properties = F.to_json(F.create_map(
        id_name, c("id").cast("string"),
        zone_name, F.concat(F.lit("Zone "), c("id").cast("string")),
        F.lit("Borough"), F.concat(F.lit("Row "), F.floor((c("id") - 1) / 17).cast("string")),
    ))
    return cells.select(
        F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'),
                 geometry, F.lit("}")).alias("feature")
    )


def _instead(column: str, cases: dict[int, Column]) -> Column:
    """``column``, replaced in the rows of some flaw classes."""
    out = F.col(column)
    for k, value in cases.items():
        out = F.when(F.col("k") == k, value).otherwise(out)
    return out


def _at(text: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


def flawed_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`seeds` whose pickup zone and time have the flaws of :func:`flawed_bronze`; ``zone`` is the one without."""
    c = F.col
    times = {
        13: c("pickup_datetime") - F.expr("INTERVAL 1000 DAY"), 20: _at("2025-11-02 01:50:00"), 21: _at("2025-03-09 01:50:00"),
        22: _at("2025-03-09 02:30:00"), 24: _at("2025-01-02 03:00:00"),
    }
    rows = seeds(spark, sf_dir).withColumn("k", _trip_time() % 211)
    return rows.withColumns(
        {"zone": c("PULocationID"), "PULocationID": _instead("PULocationID", {0: F.lit(0)}), "pickup_datetime": _instead("pickup_datetime", times)}
    ).drop("k")


def flawed_bronze(seeds: DataFrame, *beside: str) -> DataFrame:
    """The trips of :func:`flawed_seeds` in bronze form with flaws by the class of their duration: every quality check finds some.

    One class of 211 has a zone below the range, the next one above it, and so on: distances, times and
    amounts below zero, times outside the window, in clock changes and in hours that did not exist, odd flags.
    """
    c = F.col

    def below(column: str, unit: int) -> Column:
        return (-F.rint(c(column) * unit) - 1) / unit

    cent = F.lit(-0.01)
    kept = {"PULocationID": "flawed_zone", "pickup_datetime": "flawed_time"}  # as they lie: nothing is computed of them again
    plain = seeds.withColumns({flawed: c(x) for x, flawed in kept.items()}).withColumns({"PULocationID": c("zone"), "pickup_datetime": _pickup()})
    rows = made(plain, *kept.values(), *beside).withColumn("k", c("trip_time") % 211)
    yes, no = F.lit("Y"), F.lit("N")
    flaws = {
        "DOLocationID": {1: F.lit(300)},
        "trip_miles": {2: below("trip_miles", 1000), 17: F.lit(150.0)},
        "trip_time": {3: -c("trip_time"), 15: F.lit(5), 16: F.lit(30000), 20: F.lit(1200), 21: F.lit(1200)},
        "base_passenger_fare": {4: below("base_passenger_fare", 100)},
        "driver_pay": {5: below("driver_pay", 100)},
        "tips": {6: F.lit(-1.0)},
        "tolls": {7: cent}, "bcf": {8: cent}, "sales_tax": {9: cent}, "congestion_surcharge": {10: cent}, "airport_fee": {11: cent},
        "cbd_congestion_fee": {12: cent, 24: F.lit(1.5)},
        "dropoff_datetime": {14: c("pickup_datetime"), 19: _at("2026-05-02 00:00:00"), 20: _at("2025-11-02 01:10:00"), 21: _at("2025-03-09 03:10:00")},
        "request_datetime": {18: _at("2024-12-31 23:00:00"), 23: _at("2025-03-09 02:10:00")},
        "access_a_ride_flag": {25: yes}, "wav_request_flag": {25: yes, 26: yes}, "wav_match_flag": {26: no},
    }
    columns = [c(kept[x]).alias(x) if x in kept else _instead(x, flaws.get(x, {})).alias(x) for x in COLUMNS]
    return to_bronze(rows.select(*columns, *beside), *beside)


def flawed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flawed trips in bronze form."""
    return flawed_bronze(flawed_seeds(spark, sf_dir))


def with_month(seeds: DataFrame) -> DataFrame:
    """Seeds with the ``file_month`` that their trips are published in."""
    return seeds.withColumn("file_month", month_key(F.col("pickup_datetime")))


def month_rows(seeds: DataFrame) -> DataFrame:
    """Month-file rows with ``file_month``, in each task month by month: the few columns are sorted, not the trips."""
    rows = seeds.drop("pickup_datetime").sortWithinPartitions("file_month")
    return made(rows.withColumn("pickup_datetime", _pickup()), "file_month")


def flawed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-file rows with ``file_month`` and flaws a load must find: copies, NULLs, empty rows, rows of other months."""
    c = F.col
    k = _trip_time() % 211
    copies = F.when(k == 30, 2).when(k == 31, 3).otherwise(1)
    copied = with_month(seeds(spark, sf_dir)).withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
    rows = month_rows(copied).withColumn("k", c("trip_time") % 211)
    later = c("pickup_datetime") + F.expr("INTERVAL 45 DAY")
    flaws = {"tips": {32: F.lit(None)}, "pickup_datetime": {34: later}}
    return rows.select(
        *[F.when(c("k") != 33, _instead(x, flaws.get(x, {}))).alias(x) for x in COLUMNS], "file_month"
    )


def offers(spark: SparkSession, sf_dir: str, rates: tuple[int, ...] = (2, 5, 8, 11, 14)) -> DataFrame:
    """A table of bonus offers, one per trip that passes the quality filter: the tried rate rotates.

    No offers were ever made in the data at hand, so whether one was answered is part of this stand-in table.
    """
    c = F.col
    rows = t.measures(trips(spark, sf_dir))
    tried = F.element_at(
        F.array(*[F.lit(r).cast("bigint") for r in rates]),
        (F.pmod(c("secs") + c("pu_location_id"), F.lit(len(rates))) + 1).cast("int"),
    )
    return rows.select(
        "pu_location_id", "hour_of_day", tried.alias("rate_pct"),
        (F.coalesce("wait", F.lit(0)) < 400 + tried * 40).alias("responded"),
        "pay", (c("base") - c("pay")).alias("margin"),
    )
