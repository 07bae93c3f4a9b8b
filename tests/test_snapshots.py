"""Snapshots of bronze and gold, refresh of changed months, and the footers they count from."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from rows import at, source, trip, zones

from curbflow.contract import COLUMNS, month_key, to_bronze
from curbflow.operators import profile
from curbflow.plans import marts
from curbflow.sinks import bronze, gold, snapshots
from curbflow.sources import footers, months
from curbflow.streaming import ingest


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


def days(*texts, **changes):
    return [trip(pickup_datetime=at(f"{x} 10:05:00"), request_datetime=at(f"{x} 10:00:00"), dropoff_datetime=at(f"{x} 10:25:00"), **changes) for x in texts]


def trips(spark, rows):
    return to_bronze(source(spark, rows))


def per_month(spark, table):
    return {r.pickup_month: r.existing for r in bronze.month_counts(spark, table).collect()}


def test_a_load_that_dies_leaves_the_old_snapshot(spark, folder):
    table = f"{folder}/trips"
    bronze.write_months(trips(spark, days("2025-05-05", "2025-06-02")), table)
    bad = trips(spark, days("2025-05-06", "2025-05-07", "2025-06-03")).repartition(3)
    broken = bad.withColumn("tips", F.when(F.col("pickup_datetime") > "2025-06-01", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("tips")))
    with pytest.raises(Exception, match="lost"):
        bronze.write_months(broken, table)
    assert per_month(spark, table) == {202505: 1, 202506: 1}
    assert bronze.read(spark, table).count() == 2
    # staged whole, and dead before its commit: still nothing to see, and removed once it is old
    snapshots.stage(bad.withColumn("pickup_month", month_key(F.col("pickup_datetime"))), table, "pickup_month")
    assert bronze.read(spark, table).count() == 2
    loads = lambda: {n for n in os.listdir(table) if n.startswith("load=")}
    assert len(loads()) == 3
    assert snapshots.expire(spark, table) == []  # a load just written may still be running
    assert len(snapshots.expire(spark, table, grace_seconds=-60)) == 2 and len(loads()) == 1
    assert bronze.read(spark, table).count() == 2


def test_of_two_loads_of_a_month_one_is_refused(spark, folder):
    table = f"{folder}/trips"
    bronze.write_months(trips(spark, days("2025-05-05", "2025-06-02")), table)
    base = snapshots.current(spark, table)

    def load(day, n, by="pickup_month"):
        rows = trips(spark, days(*[day] * n)).withColumn(by, month_key(F.col("pickup_datetime")))
        return snapshots.stage(rows, table, by), rows.drop(by).schema

    may, schema = load("2025-05-05", 3)
    june, _ = load("2025-06-02", 4)
    again, _ = load("2025-05-09", 5)
    assert snapshots.commit(spark, table, base, may, schema, "pickup_month").version == 2
    # another month goes on from what was committed meanwhile, the same month does not
    assert snapshots.commit(spark, table, base, june, schema, "pickup_month").version == 3
    with pytest.raises(snapshots.Conflict, match="202505"):
        snapshots.commit(spark, table, base, again, schema, "pickup_month")
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, table, base, again, schema, "pickup_month", everything=True)
    assert per_month(spark, table) == {202505: 3, 202506: 4}
    assert bronze.read(spark, table, version=1).count() == 2  # the older ones stay readable
    snapshots.expire(spark, table, keep=1)
    assert snapshots.versions(spark, table) == [3] and bronze.read(spark, table).count() == 7
    assert not os.path.exists(f"{table}/{base.parts['202505'].folder}")


def test_a_taken_name_is_not_taken_again(spark, folder):
    new = snapshots.Snapshot(1, spark.range(1).schema, None, {})
    assert snapshots._taken(spark, folder, new) and not snapshots._taken(spark, folder, new)
    assert snapshots.read(spark, folder).count() == 0


def test_two_builds_of_a_table_from_one_version(spark, folder, monkeypatch):
    assert gold.publish(spark.range(3), folder, "t") == 1
    stage = snapshots.stage

    def overtaken(*args):
        parts = stage(*args)
        monkeypatch.setattr(snapshots, "stage", stage)
        gold.publish(spark.range(5), folder, "t")
        return parts

    monkeypatch.setattr(snapshots, "stage", overtaken)
    with pytest.raises(snapshots.Conflict):
        gold.publish(spark.range(7), folder, "t")
    assert gold.current(spark, folder, "t").count() == 5
    os.makedirs(f"{folder}/t/vnext")  # a name of someone else's
    assert gold.publish(spark.range(2), folder, "t") == 3


def test_tables_of_the_older_layout_are_read_and_replaced(spark, folder):
    spark.range(4).write.parquet(f"{folder}/t/v2")
    assert gold.current(spark, folder, "t").count() == 4 and gold.versions(spark, folder, "t") == [2]
    assert gold.publish(spark.range(1), folder, "t") == 3
    assert gold.current(spark, folder, "t").count() == 1


def test_empty_tables_keep_their_columns(spark, folder):
    gold.publish(spark.range(1).where("false"), folder, "t")
    assert gold.current(spark, folder, "t").columns == ["id"] and gold.current(spark, folder, "t").count() == 0


def test_only_changed_months_are_computed_again(spark, folder, monkeypatch):
    few = ("mart_overview_daily", "mart_pricing", "mart_airports", "mart_routes")  # two of a grain, and two alone
    monkeypatch.setattr(marts, "MARTS", {k: marts.MARTS[k] for k in few})
    table, root, dim = f"{folder}/trips", f"{folder}/gold", zones(spark)
    rows = [trip(w, PULocationID=p, pickup_datetime=at(f"2025-0{m}-0{1 + w % 5} 10:05:00"), dropoff_datetime=at(f"2025-0{m}-0{1 + w % 5} 10:25:00"))
            for w in (10, 650, 950) for p in (10, 132) for m in (4, 5, 6)]
    bronze.write_months(trips(spark, rows), table)
    assert set(gold.refresh(spark, table, dim, root).values()) == {1}
    asked = []
    build = gold.build_all
    monkeypatch.setattr(gold, "build_all", lambda t, z, r, months, note: asked.append(months) or build(t, z, r, months, note))

    def check():
        for name in marts.MARTS:
            want = marts.build(name, bronze.read(spark, table), dim)
            got = gold.current(spark, root, name)
            assert got.columns == want.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name

    before = {n: snapshots.current(spark, f"{root}/{n}").parts for n in marts.MARTS}
    may = [trip(333, PULocationID=132, pickup_datetime=at("2025-05-09 11:00:00"), dropoff_datetime=at("2025-05-09 11:25:00"))]
    bronze.write_months(trips(spark, may), table)
    assert set(gold.refresh(spark, table, dim, root).values()) == {2} and asked == [[202505]]
    check()
    for name, parts in before.items():  # the other months are the files they were
        now = snapshots.current(spark, f"{root}/{name}").parts
        assert {k: p for k, p in now.items() if k != "202505"} == {k: p for k, p in parts.items() if k != "202505"}
    # a month whose trips all fail the filter leaves the marts; nothing changed computes nothing
    bronze.write_months(trips(spark, days("2025-06-02", driver_pay=0.0)), table)
    gold.refresh(spark, table, dim, root)
    assert asked[1:] == [[202506]] and "202506" not in snapshots.current(spark, f"{root}/mart_routes").parts
    check()
    gold.refresh(spark, table, dim, root)
    assert asked[2:] == [[]]
    check()
    # other zone names change every month
    gold.refresh(spark, table, dim.withColumn("zone", F.concat("zone", F.lit("!"))), root)
    assert asked[3:] == [None]
    gold.expire(spark, root)
    assert gold.versions(spark, root, "mart_routes") == [5]


def test_footers_tell_rows_nulls_and_limits(spark, folder):
    rows = [(i, None if i % 3 else f"t{i}", at("2025-05-05 10:00:00") if i else None, i / 2) for i in range(10)]
    df = spark.createDataFrame(rows, "a INT, b STRING, c TIMESTAMP_NTZ, d DOUBLE").coalesce(1)
    df.write.parquet(f"{folder}/x y/one")
    df.where("false").write.parquet(f"{folder}/x y/none")
    files = spark.createDataFrame([(f"file:{d}/{n}",) for d, _, ns in os.walk(f"{folder}/x y") for n in ns if n.endswith(".parquet")], "path STRING")
    for found in (footers.footers(files), files.sparkSession.read.format("binaryFile").load([r.path for r in files.collect()]).select("path", "content").mapInPandas(footers._reader(True), footers.FOOTER)):
        got = {r.column_name: r for r in found.where("rows > 0").collect()}
        assert {k: (r.rows, r.nulls, r.type, r.position) for k, r in got.items()} == {
            "a": (10, 0, "int", 0), "b": (10, 6, "string", 1), "c": (10, 1, "timestamp_ntz", 2), "d": (10, 0, "double", 3)}
        assert (got["a"].low, got["a"].high) == ("0", "9") and got["c"].low == "2025-05-05 10:00:00"
        assert footers.row_counts(found).first().rows == 10
        assert found.where("rows = 0").count() == 4
    assert footers.footers(files.where("false")).count() == 0


def test_counts_from_footers_equal_counts_from_rows(spark, folder):
    def rows(xs):
        return source(spark, xs).withColumn("file_month", F.coalesce(month_key(F.col("pickup_datetime")), F.lit(202506)))

    plain = rows(days("2025-05-05", "2025-05-06", originating_base_num=None) + days("2025-06-02"))
    months.write(plain, folder)
    months.write(source(spark, days("2025-06-30", "2025-07-01")).withColumn("file_month", F.lit(202507)), folder)  # one foreign row
    months.write(source(spark, [dict.fromkeys(COLUMNS)] + days("2025-08-01")).withColumn("file_month", F.lit(202508)), folder)  # an empty row
    months.write(rows(days("2025-09-01", "2025-09-02")), folder, "csv")
    key = lambda df: sorted(tuple(r[k] for k in ("file_month", "rows", "empty_rows", "foreign_rows", *COLUMNS)) for r in df.collect())
    read = months.read(spark, folder)
    seen = months.inspect(spark, folder, f"{folder}/_footers")
    assert key(profile.folder_counts(read, seen)) == key(profile.null_counts(read))
    assert {r.file_month: r.expected for r in bronze.folder_counts(spark, seen).collect()} == {202505: 2, 202506: 1, 202507: 2, 202508: 2, 202509: 2}


def test_stream_picks_up_csv_months(spark, folder):
    files, table, state = f"{folder}/in", f"{folder}/trips", f"{folder}/state"
    one = source(spark, days("2025-05-05")).withColumn("file_month", F.lit(202505))
    months.write(one, files, "csv")
    ingest.ingest(spark, files, table, state)
    months.write(source(spark, days("2025-06-02", "2025-06-03")).withColumn("file_month", F.lit(202506)), files)
    ingest.ingest(spark, files, table, state)
    assert per_month(spark, table) == {202505: 1, 202506: 2}


def test_bounded_files_and_zone_filters_that_skip_files(spark, folder):
    """One zone holds a third of all trips; every file stays within its bound and names its zones."""
    rows = [trip(PULocationID=77 if i % 3 == 0 else 1 + i % 200, tips=float(i)) for i in range(3000)]
    table = f"{folder}/trips"
    bronze.write_months(trips(spark, rows).repartition(5), table, scattered=True, file_rows=100)
    files = snapshots.ranges_of(spark, table).collect()
    assert max(f.rows for f in files) <= 100 and sum(f.rows for f in files) == 3000
    stored = bronze.read(spark, table).select("PULocationID", "_metadata.file_path").collect()
    for f in files:
        own = [r.PULocationID for r in stored if r.file_path.endswith(f.file)]
        assert (f.low_PULocationID, f.high_PULocationID, f.rows) == (min(own), max(own), len(own))
    got = bronze.read_zones(spark, table, 10, 20)
    want = [r["tips"] for r in rows if 10 <= r["PULocationID"] <= 20]
    assert sorted(r.tips for r in got.collect()) == sorted(want)
    assert len(got.inputFiles()) < len(files) / 3
    assert bronze.read_zones(spark, table, 900, 901).count() == 0
    # a later load of another month keeps the ranges of both
    bronze.write_months(trips(spark, days("2025-08-08", PULocationID=15)), table)
    assert bronze.read_zones(spark, table, 15, 15).count() == 1 + sum(r["PULocationID"] == 15 for r in rows)


def test_order_is_checked_where_it_lies(spark, folder):
    from curbflow.plans import expressions

    rows = [trip(PULocationID=1 + i * 37 % 200, tips=float(i)) for i in range(400)]
    bronze.write_months(trips(spark, rows), f"{folder}/sorted")
    good = expressions.stored_order(bronze.read(spark, f"{folder}/sorted"))
    assert [tuple(r) for r in good.collect()] == [(202506, 400, 0)]
    text = good._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text
    zone = [r["PULocationID"] for r in rows]
    df = trips(spark, rows).coalesce(1).withColumn("pickup_month", F.lit(202506))
    snapshots.commit(spark, f"{folder}/raw", None, snapshots.stage(df, f"{folder}/raw", "pickup_month"), df.drop("pickup_month").schema, "pickup_month")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for n in ("10000", "7"):  # seams between batches are compared, too
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
        found = expressions.stored_order(bronze.read(spark, f"{folder}/raw")).first()
        assert (found.rows, found.out_of_order) == (400, sum(a > b for a, b in zip(zone, zone[1:])))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
