"""Hot groups, plan shapes, and work that must not grow with the data."""

import re
import statistics

import pytest
from pyspark.sql import functions as F
from rows import PLAIN, bronze, trip, zones

import __spark_entry__ as entry
from curbflow.contract import COLUMNS, SOURCE_SCHEMA, to_bronze
from curbflow.functions import trip as t
from curbflow.functions.grouping import fold, unfold
from curbflow.plans import marts, rollups

QUERIES = entry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def details(df) -> str:
    """Plan with untruncated scan details."""
    return df.sparkSession.sparkContext._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


def quantile(values, q):
    values, at = sorted(values), q * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


def test_quantiles_with_a_third_of_all_rows_in_one_group(spark):
    rows = [(i % 3 and i % 17 + 1, (i * 7919) % 1300 if i % 11 else None) for i in range(30_000)]
    df = spark.createDataFrame(rows, "g INT, v BIGINT")
    got = unfold(fold(df, ["g"], {"s": "v"}, "v"), ["g"], ["s"], "v", {"p50": 0.5, "p90": 0.9})
    for r in got.collect():
        values = [v for g, v in rows if g == r.g and v is not None]
        assert r.trips == sum(g == r.g for g, _ in rows)
        assert (r.s, r.p50) == (sum(values), statistics.median(values))
        assert abs(r.p90 - quantile(values, 0.9)) < 1e-6


def test_quantiles_of_every_size_match_brute_force(spark):
    rows = [(n, (i * 37) % 101) for n in range(1, 60) for i in range(n)]
    df = spark.createDataFrame(rows, "g INT, v BIGINT")
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = {r.g: r for r in unfold(fold(df, ["g"], {}, "v"), ["g"], [], "v", wanted).collect()}
    for n in range(1, 60):
        values = [v for g, v in rows if g == n]
        for name, q in wanted.items():
            assert abs(got[n][name] - quantile(values, q)) < 1e-9, (n, name)


def test_hot_operator_in_marts(spark):
    """Two thirds of the trips are one operator, day and zone."""
    columns = [
        F.lit(PLAIN[c]).cast(SOURCE_SCHEMA[c].dataType).alias(c) for c in COLUMNS
        if c not in ("request_datetime", "hvfhs_license_num")
    ]
    df = spark.range(20_000).select(
        "id", *columns,
        F.when(F.col("id") % 3 == 0, "HV0005").otherwise("HV0003").alias("hvfhs_license_num"),
    ).withColumn("request_datetime", F.timestamp_add(
        "SECOND", -(F.col("id") % 1000).cast("int"), F.col("pickup_datetime")))
    rows = {r.operator: r for r in
            marts.build("mart_pickup_zones", to_bronze(df), zones(spark)).collect()}
    uber = [i % 1000 for i in range(20_000) if i % 3]
    assert rows["Uber"].trips == len(uber)
    assert rows["Uber"].wait_p50 == statistics.median(uber)
    assert rows["Uber"].wait_p90 == round(quantile(uber, 0.9), 1)


def test_merged_daily_counts_equal_direct_quantiles(spark):
    m = t.measures(bronze(spark, [trip(w) for w in range(0, 900, 7)]))
    merged = rollups.merged_quantiles(rollups.daily_wait_counts(m)).collect()[0]
    assert merged.wait_p50 == statistics.median(range(0, 900, 7))


def test_scan_reads_only_needed_columns_and_pushes_filters(spark, small):
    text = details(QUERIES["mart_routes"](spark, small))
    schema = re.search(r"ReadSchema: struct<([^>]*pickup_datetime[^>]*)>", text)
    read = {c.split(":")[0] for c in schema.group(1).split(",")}
    assert read <= {"pickup_datetime", "PULocationID", "DOLocationID", "trip_miles", "trip_time",
                    "base_passenger_fare", "driver_pay"}
    for pushed in ("GreaterThan(trip_miles,0.0)", "GreaterThanOrEqual(trip_time,30)",
                   "GreaterThan(base_passenger_fare,0.0)", "GreaterThan(driver_pay,0.0)"):
        assert pushed in text


@pytest.mark.parametrize("name", sorted(set(marts.MARTS)))
def test_marts_scan_bronze_once_without_udf_or_cross_join(spark, small, name):
    text = details(QUERIES[name](spark, small))
    assert len(re.findall(r"ReadSchema: struct<[^>]*pickup_datetime", text)) == 1
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas"):
        assert word not in text


def test_no_query_uses_cross_joins_or_python(spark, small):
    for name in ("neighbour_spill", "session_dedupe", "itt_summary", "balance_check",
                 "deficit_window_select", "geo_explode_polygons", "reagg_bias_report"):
        text = plan(QUERIES[name](spark, small))
        assert "CartesianProduct" not in text and "Python" not in text, name


def test_airports_are_split_after_the_fold(spark, small):
    lines = plan(QUERIES["mart_airports"](spark, small)).splitlines()
    depth = {k: next(i for i, x in enumerate(lines) if k in x) for k in ("Generate", "FileScan")}
    between = "\n".join(lines[depth["Generate"]:depth["FileScan"]])
    assert "partial_count" in between and "Exchange" in between


def test_month_filter_prunes_partitions(spark, small):
    from curbflow.workspace import Workspace

    text = details(Workspace(spark, small).trips().where("pickup_month = 202506"))
    assert re.search(r"PartitionFilters: \[.*pickup_month.*202506", text)
