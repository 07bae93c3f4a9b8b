"""Which cells of zone, hour and month the deficit queries look at."""

from types import SimpleNamespace

import duckdb
import pytest
from rows import at, bronze, trip, zones

from curbflow import registry
from oracles.baselines import DEFICIT

# zone 10 waits long in two months, with one trip in each; zone 30 in one month only
TRIPS = [
    trip(1000, pickup_datetime=at("2025-05-05 04:10:00"), PULocationID=10),
    trip(1100, pickup_datetime=at("2025-06-02 04:20:00"), PULocationID=10),
    trip(1000, pickup_datetime=at("2025-05-05 04:10:00"), PULocationID=30),
    trip(100, pickup_datetime=at("2025-06-02 04:20:00"), PULocationID=30),
]


def test_every_cell_counts_toward_the_deficit_hours(spark):
    space = SimpleNamespace(spark=spark, trips=lambda: bronze(spark, TRIPS), zones=lambda: zones(spark))
    found = [(r.pu_location_id, r.deficit_hours, r.trips, r.zone_rank) for r in registry._deficit(space).collect()]
    assert found == [(10, 1, 2, 1)]


@pytest.mark.parametrize("trips, ranked", [(1, [(10, 1, 2)]), (2, [(10, 1, 4)])])
def test_the_statement_counts_the_same_cells(trips, ranked):
    con = duckdb.connect()
    con.execute("CREATE TABLE silver (pu INTEGER, hour_of_day INTEGER, month DATE, wait BIGINT)")
    for month in ("2025-05-01", "2025-06-01"):
        con.execute(f"INSERT INTO silver SELECT 10, 4, DATE '{month}', 1000 FROM range({trips})")
    con.execute("INSERT INTO silver VALUES (30, 4, DATE '2025-05-01', 1000), (30, 4, DATE '2025-06-01', 100)")
    assert con.sql(f"WITH {DEFICIT} SELECT pu, deficit_hours, trips FROM ranked").fetchall() == ranked
