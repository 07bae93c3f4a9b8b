"""What is moved and sorted to lay stand-in trips out, and what is computed once."""

import re

import pytest
from pyspark.sql import functions as F

from curbflow import registry
from curbflow.contract import COLUMNS, PARTITION, month_key
from curbflow.operators import geometry
from curbflow.sinks import bronze
from curbflow.sources import derived, months
from curbflow.workspace import Workspace


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """A folder with a few hundred order lines, some of them null."""
    folder = str(tmp_path_factory.mktemp("lines"))
    spark.range(2000).selectExpr(
        "IF(id % 50 = 7, NULL, id * 31) AS l_orderkey", "id % 190 AS l_partkey", "id % 10 AS l_suppkey",
        "CAST(IF(id % 40 = 3, NULL, id % 7) AS INT) AS l_linenumber", "CAST(id % 50 AS DOUBLE) AS l_quantity", "1000.5D + id AS l_extendedprice",
        "0.05D AS l_discount", "0.02D AS l_tax", "IF(id % 30 = 4, NULL, IF(id % 3 = 0, 'R', 'N')) AS l_returnflag", "'O' AS l_linestatus",
    ).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def widths(spark, write) -> list[int]:
    """Columns of the rows that each exchange and each sort of the writes that ``write`` does brings into order."""
    jvm, seen = spark.sparkContext._jvm, []
    # what a write runs is what its rows' plan says: planned here as it stands before the write's own rules
    for rows in write:
        text = jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
        for node in re.findall(r"\(\d+\) (?:Exchange|Sort)[^\n]*\nInput \[(\d+)\]", text):
            seen.append(int(node))
    return seen


@pytest.mark.parametrize("rows, made", [(derived.seeds, derived.bronze), (derived.flawed_seeds, derived.flawed_bronze)])
def test_bronze_moves_and_sorts_the_few_columns_of_a_seed(spark, lines, tmp_path, monkeypatch, rows, made):
    written = []
    stage = bronze.snapshots.stage
    monkeypatch.setattr(bronze.snapshots, "stage", lambda r, *a: written.append(r) or stage(r, *a))
    bronze.write_months(rows(spark, lines), str(tmp_path), scattered=True, made=made)
    moved = widths(spark, written)
    assert len(moved) >= 2 and max(moved) <= 12 < len(COLUMNS)
    # the rows come in the order that the writer asks for, so it does not sort them again
    order = written[0]._jdf.queryExecution().optimizedPlan().outputOrdering()
    assert PARTITION in order.apply(0).sql()
    stored = bronze.read(spark, str(tmp_path))
    want = made(rows(spark, lines)).withColumn(PARTITION, month_key(F.col("pickup_datetime")))
    assert stored.exceptAll(want).count() == 0 and want.exceptAll(stored).count() == 0


def test_month_files_sort_seeds_by_number(spark, lines):
    w = Workspace(spark, lines)
    for rows in (w.source(), derived.flawed_source(spark, lines)):
        sorts = widths(spark, [rows])
        assert sorts and max(sorts) <= 11
        assert "file_month" in rows._jdf.queryExecution().optimizedPlan().outputOrdering().apply(0).sql()


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_month_folders_have_the_published_names(spark, lines, tmp_path, fmt):
    rows = Workspace(spark, lines).source().where("file_month IN (202501, 202502)")
    months.write(rows, str(tmp_path), fmt)
    assert sorted(x.name for x in tmp_path.iterdir()) == [f"file=fhvhv_tripdata_2025-0{m}.{fmt}" for m in (1, 2)]
    back = months.read(spark, str(tmp_path))
    assert back.exceptAll(rows).count() == 0 and back.count() == rows.count()


def test_generated_code_of_flawed_trips_can_be_compiled(spark, lines):
    """A method above 8,000 bytes is only interpreted: the flaws come in two steps, with the shuffle between them."""
    rows = derived.flawed_seeds(spark, lines).sortWithinPartitions("PULocationID")
    text = spark.sparkContext._jvm.PythonSQLUtils.explainString(derived.flawed_bronze(rows)._jdf.queryExecution(), "codegen")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_adjacency_parses_features_once(spark, tmp_path):
    cell = '{"type":"Feature","properties":{"LocationID":"%d"},"geometry":{"type":"Polygon","coordinates":[[[%d,0],[%d,0],[%d,1],[%d,1],[%d,0]]]}}'
    rows = spark.createDataFrame([(cell % (i, i, i + 1, i + 1, i, i),) for i in range(3)], "feature STRING")
    met = geometry.adjacency(rows, f"{tmp_path}/segments")
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan
    assert {tuple(r) for r in met.collect()} == {(0, 1), (1, 0), (1, 2), (2, 1)}


def test_rows_used_more_than_once_are_stored(spark, small):
    """The zones beside the deficit zones, and the fresh anomalies, come from files: trips are aggregated once for each."""
    for name, scans in (("neighbour_spill", 1), ("sink_replace_rows", 0)):
        text = registry.QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"Relation \[hvfhs_license_num", text)) == scans, name
