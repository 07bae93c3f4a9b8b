"""Month files, idempotent loading, publishing, export and the whole pipeline."""

import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F
from rows import at, source, trip, zones

from curbflow import pipeline
from curbflow.contract import ContractError, month_key, to_bronze
from curbflow.functions.fixed import plain_number
from curbflow.operators import contract_checks, profile, quality
from curbflow.plans import marts
from curbflow.sinks import bronze, csv_export, gold
from curbflow.sources import months
from curbflow.sources import zones as zone_source
from curbflow.streaming import ingest

MAY, JUNE = at("2025-05-05 10:00:00"), at("2025-06-02 10:05:00")


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


def month_rows(spark, rows):
    return source(spark, rows).withColumn("file_month", month_key(F.col("pickup_datetime")))


def in_may(**changes):
    return trip(pickup_datetime=MAY, request_datetime=at("2025-05-05 09:55:00"),
                dropoff_datetime=at("2025-05-05 10:20:00"), **changes)


def statuses(df):
    return {r.file_month: (r.status, r.rows) for r in df.collect()}


def test_inventory_prefers_parquet_and_reads_single_files(spark, folder):
    rows = month_rows(spark, [trip(), trip(), in_may()])
    months.write(rows, folder, "csv")
    months.write(rows.where("file_month = 202506"), folder, "parquet")
    # a plain single file, as published
    part = f"{folder}/plain"
    source(spark, [trip()]).coalesce(1).write.parquet(part)
    name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
    shutil.copy(f"{part}/{name}", f"{folder}/fhvhv_tripdata_2025-07.parquet")
    open(f"{folder}/notes_2025-01.csv", "w").close()
    found = {r.month: r.format for r in months.inventory(spark, folder).collect()}
    assert found == {202505: "csv", 202506: "parquet", 202507: "parquet"}
    counts = months.read(spark, folder).groupBy("file_month").count().collect()
    assert {r.file_month: r["count"] for r in counts} == {202505: 1, 202506: 2, 202507: 1}


def test_csv_round_trip_keeps_nulls_and_times(spark, folder):
    rows = month_rows(spark, [trip(on_scene_datetime=None, originating_base_num=None), trip(tips=1.25)])
    months.write(rows, folder, "csv")
    months.csv_to_parquet(spark, folder)
    assert [r.format for r in months.inventory(spark, folder).collect()] == ["parquet"]
    key = lambda r: (r.tips, r.on_scene_datetime is None)
    back = sorted(months.read(spark, folder).select(*rows.columns).collect(), key=key)
    assert back == sorted(rows.collect(), key=key)


def test_load_twice_skips_and_a_short_month_is_replaced(spark, folder):
    rows = month_rows(spark, [trip(), trip(tips=1.0), in_may()])
    table = f"{folder}/trips"
    assert statuses(bronze.load(spark, rows, table)) == {202505: ("loaded", 1), 202506: ("loaded", 2)}
    assert statuses(bronze.load(spark, rows, table)) == {202505: ("skipped", 1), 202506: ("skipped", 2)}
    bronze.write_months(to_bronze(rows.where("tips = 1.0")), table)
    assert statuses(bronze.load(spark, rows, table)) == {202505: ("skipped", 1), 202506: ("replaced", 2)}
    assert statuses(bronze.load(spark, rows, table, force=True))[202505] == ("replaced", 1)


def test_months_without_a_file_stay(spark, folder):
    table = f"{folder}/trips"
    bronze.load(spark, month_rows(spark, [trip(), in_may()]), table)
    bronze.load(spark, month_rows(spark, [trip(), trip()]), table)
    stored = {r.pickup_month: r.existing for r in bronze.month_counts(spark, table).collect()}
    assert stored == {202505: 1, 202506: 2}


def test_foreign_month_blocks_before_writing(spark, folder):
    rows = source(spark, [trip(), in_may()]).withColumn("file_month", F.lit(202506))
    with pytest.raises(ValueError, match="202506: 1"):
        bronze.load(spark, rows, f"{folder}/trips")
    assert not os.path.exists(f"{folder}/trips")


def test_bronze_files_are_sorted(spark, folder):
    rows = [trip(PULocationID=1 + i * 37 % 200, tips=float(i)) for i in range(400)]
    bronze.write_months(to_bronze(source(spark, rows)), f"{folder}/t")
    data = spark.read.parquet(f"{folder}/t").select(
        "PULocationID", "_metadata.file_path", "_metadata.row_index").collect()
    by_file = {}
    for r in sorted(data, key=lambda r: (r.file_path, r.row_index)):
        by_file.setdefault(r.file_path, []).append(r.PULocationID)
    assert all(v == sorted(v) for v in by_file.values())
    assert sum(map(len, by_file.values())) == 400


def test_readers_never_see_an_uncommitted_version(spark, folder):
    one, two = spark.range(1), spark.range(2)
    assert gold.publish(one, folder, "t") == 1
    os.makedirs(f"{folder}/t/v2")  # a build that died
    assert gold.current(spark, folder, "t").count() == 1
    assert gold.publish(two, folder, "t") == 3
    assert gold.current(spark, folder, "t").count() == 2


def test_shared_build_equals_single_builds(spark, folder):
    rows = [trip(w, PULocationID=p, shared_request_flag=f, tips=float(w % 7))
            for w in (-5, 10, 650, 950) for p in (10, 30, 132) for f in "YN"]
    trips, dim = to_bronze(source(spark, rows)), zones(spark)
    gold.build_all(trips, dim, folder)
    for name in marts.MARTS:
        stored = gold.current(spark, folder, name)
        single = marts.build(name, trips, dim)
        assert stored.columns == single.columns
        assert sorted(map(str, stored.collect())) == sorted(map(str, single.collect())), name


def test_export_bytes(spark, folder):
    df = spark.createDataFrame(
        [("b", 2, 20406237.58, None), ('a "x", y', 1, 250.0, 0.0001)],
        "operator STRING, trips BIGINT, fare DOUBLE, p50 DOUBLE")
    assert csv_export.export(df, f"{folder}/t.csv", single=True) == 2
    parts = [f for f in os.listdir(f"{folder}/t.csv") if f.startswith("part-")]
    assert len(parts) == 1
    data = open(f"{folder}/t.csv/{parts[0]}", "rb").read()
    assert data == (b'\xef\xbb\xbf"operator","trips","fare","p50"\n'
                    b'"a ""x"", y",1,250,0.0001\n"b",2,20406237.58,\\N\n')
    csv_export.export(df, f"{folder}/s.csv", sep=";", single=True)
    part = next(f for f in os.listdir(f"{folder}/s.csv") if f.startswith("part-"))
    assert open(f"{folder}/s.csv/{part}", encoding="utf-8-sig").readline() == '"operator";"trips";"fare";"p50"\n'


def test_numbers_keep_every_digit(spark):
    values = [0.0, 1.5, -2.0, 1e-7, 1.23456789012345e-9, 12345678.125, 1e25, 1e300, float("nan"), float("-inf"), None, 250.0, 1 / 3]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    got = [r[0] for r in df.select(plain_number("x")).collect()]
    assert got == ["0", "1.5", "-2", "0.0000001", "0.00000000123456789012345", "12345678.125", "1" + "0" * 25, "1.0E300",
                   "NaN", "-Infinity", None, "250", "0.3333333333333333"]


def test_export_parts_are_one_sorted_file(spark, folder):
    df = spark.range(1000).select(F.col("id").alias("location_id")).repartition(4)
    csv_export.export(df, f"{folder}/t.csv")
    parts = sorted(f for f in os.listdir(f"{folder}/t.csv") if f.startswith("part-"))
    text = "".join(open(f"{folder}/t.csv/{f}", encoding="utf-8").read() for f in parts)
    assert text == '\ufeff"location_id"\n' + "".join(f"{i}\n" for i in range(1000))


def test_export_sort_columns():
    assert csv_export.sort_columns(["operator", "distance_bin_miles", "month", "trips"]) == [
        "month", "distance_bin_miles", "operator"]
    assert csv_export.sort_columns(["x", "y"]) == ["x"]


def test_failing_export_is_reported(spark, folder):
    broken = spark.range(1).select(F.raise_error(F.lit("boom")).alias("x"))
    report = csv_export.export_all({"bad": broken, "good": spark.range(2)}, folder)
    assert [r[1] for r in report] == [None, 2]


def test_zone_lookup(spark, folder):
    with open(f"{folder}/z.csv", "w") as f:
        f.write('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n'
                '264,"Unknown","N/A","N/A"\n265,"","Outside of NYC",\n')
    got = {r.location_id: r[1:] for r in zone_source.read_lookup(spark, f"{folder}/z.csv").collect()}
    assert got[264] == ("Unknown", "N/A", "N/A")
    assert got[265] == ("N/A", "Outside of NYC", "N/A")


def test_stream_loads_late_parts_of_a_month(spark, folder):
    files, table, state = f"{folder}/in", f"{folder}/trips", f"{folder}/state"
    months.write(month_rows(spark, [trip(), in_may()]), files)
    assert ingest.ingest(spark, files, table, state) >= 1
    assert ingest.ingest(spark, files, table, state) == 0
    months.write(month_rows(spark, [trip(tips=9.0)]), files)  # one more part of June
    ingest.ingest(spark, files, table, state)
    stored = {r.pickup_month: r.existing for r in bronze.month_counts(spark, table).collect()}
    assert stored == {202505: 1, 202506: 2}


def test_pipeline(spark, folder):
    files, house = f"{folder}/files", f"{folder}/house"
    months.write(month_rows(spark, [trip(w) for w in (-5, 10, 700)] + [in_may()]), files, "csv")
    zone_source.write_lookup(zones(spark), f"{folder}/zones.csv")
    first = pipeline.load(spark, files, f"{folder}/zones.csv", house)
    assert set(first) == set(marts.MARTS) and set(first.values()) == {1}
    again = pipeline.load(spark, files, f"{folder}/zones.csv", house)
    assert set(again.values()) == {2}
    log = spark.read.parquet(f"{house}/etl_load_log").groupBy("status").count().collect()
    assert {r.status: r["count"] for r in log} == {"loaded": 2, "skipped": 2}
    assert gold.current(spark, house, "etl_anomalies").count() == 2 * 11
    assert gold.current(spark, house, "etl_column_profile").count() == 2 * 25
    assert gold.current(spark, house, "ods_checks").count() == 54
    summary = pipeline.export(spark, house, f"{folder}/out", with_quality=True, single=True).collect()
    assert len(summary) == len(marts.MARTS) + 5
    assert all(r.status == "ok" and r.files == 1 and r.bytes > 0 for r in summary)


def test_pipeline_stops_at_bad_data(spark, folder):
    zone_source.write_lookup(zones(spark), f"{folder}/zones.csv")
    months.write(month_rows(spark, [trip(), trip(tips=None)]), f"{folder}/nulls")
    with pytest.raises(profile.GateError):
        pipeline.load(spark, f"{folder}/nulls", f"{folder}/zones.csv", f"{folder}/h1")
    assert not os.path.exists(f"{folder}/h1/trips")
    months.write(month_rows(spark, [trip(), trip(tolls=-1.0)]), f"{folder}/errors")
    with pytest.raises(quality.QualityError):
        pipeline.load(spark, f"{folder}/errors", f"{folder}/zones.csv", f"{folder}/h2")
    assert not os.path.exists(f"{folder}/h2/gold")


def csv_month(folder, rows, change=lambda lines: lines, month="2025-06", part="a"):
    """A month as CSV written by hand, its lines (header first) changed."""
    names = rows.drop("file_month").columns
    body = [
        {n: "" if r[n] is None else str(r[n]) for n in names} for r in rows.collect()
    ]
    lines = change([dict(zip(names, names)), *body])
    os.makedirs(f"{folder}/fhvhv_tripdata_{month}.csv", exist_ok=True)
    with open(f"{folder}/fhvhv_tripdata_{month}.csv/part-{part}.csv", "w") as f:
        f.writelines(",".join(x.values()) + "\n" for x in lines)


def moved(lines):
    """The same columns in another order."""
    return [dict(sorted(x.items())) for x in lines]


def test_csv_columns_are_read_by_name(spark, folder):
    rows = month_rows(spark, [trip(tips=1.0, tolls=2.0), trip(tips=3.0)])
    csv_month(folder, rows, moved)
    assert months.csv_to_parquet(spark, folder) == 1
    want = sorted(map(str, rows.collect()))
    assert sorted(map(str, months.read(spark, folder).select(*rows.columns).collect())) == want


@pytest.mark.parametrize("change", [
    lambda lines: [{k: v for k, v in x.items() if k != "tips"} for x in lines],
    lambda lines: [x | {"surprise": "surprise"} for x in lines],
])
def test_csv_with_other_columns_is_refused(spark, folder, change):
    csv_month(folder, month_rows(spark, [trip()]), change)
    with pytest.raises(ContractError):
        months.csv_to_parquet(spark, folder)
    assert not [f for f in os.listdir(folder) if f.endswith(".parquet")]


def test_csv_parts_must_agree_and_bad_values_stop(spark, folder):
    rows = month_rows(spark, [trip()])
    csv_month(f"{folder}/a", rows)
    csv_month(f"{folder}/a", rows, moved, part="b")
    with pytest.raises(Exception, match="(?i)header"):
        months.csv_to_parquet(spark, f"{folder}/a")
    csv_month(f"{folder}/b", rows, lambda lines: [lines[0], lines[1] | {"tips": "many"}])
    with pytest.raises(Exception, match="(?i)malformed"):
        months.csv_to_parquet(spark, f"{folder}/b")
    for f in ("a", "b"):
        assert {r.format for r in months.inventory(spark, f"{folder}/{f}").collect()} == {"csv"}


def test_half_written_month_is_converted_again(spark, folder):
    rows = month_rows(spark, [trip(), trip(tips=5.0), trip(tips=6.0)])
    csv_month(folder, rows)
    rows.drop("file_month").limit(1).write.parquet(f"{folder}/file=fhvhv_tripdata_2025-06.parquet")
    assert months.read(spark, folder).count() == 3
    assert months.csv_to_parquet(spark, folder) == 1 and months.csv_to_parquet(spark, folder) == 0
    assert months.read(spark, folder).count() == 3
    assert {r.format for r in months.inventory(spark, folder).collect()} == {"parquet"}


def test_every_part_follows_the_contract(spark, folder):
    rows = month_rows(spark, [trip(), trip(tips=5.0)])
    months.write(rows, f"{folder}/in")
    entry = months.inventory(spark, f"{folder}/in").first().entry
    odd = rows.drop("file_month", "cbd_congestion_fee").withColumn("surprise", F.lit(1))
    odd.coalesce(1).write.mode("append").parquet(entry)
    states = contract_checks.month_columns(spark, f"{folder}/in").groupBy("status").count().collect()
    assert {r.status for r in states} >= {"ok", "missing", "extra"}
    with pytest.raises(ContractError):
        bronze.load(spark, months.read(spark, f"{folder}/in"), f"{folder}/trips")
    assert not os.path.exists(f"{folder}/trips")


def test_stream_refuses_what_the_batch_refuses(spark, folder):
    months.write(month_rows(spark, [trip(), trip(tips=None)]), f"{folder}/in")
    with pytest.raises(Exception, match="unexpected_nulls"):
        ingest.ingest(spark, f"{folder}/in", f"{folder}/trips", f"{folder}/state")
    assert not os.path.exists(f"{folder}/trips")
