"""Every registered query against its oracle on the smallest tables."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry
from curbflow import registry
from curbflow.functions import trip
from curbflow.plans import rollups
from curbflow.workspace import Workspace

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, con, name):
    df = QUERIES[name](spark, small)
    if name in SQL:
        assert differences(df, con, SQL[name]) == []
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
    # corpus operators, where present, may be beyond SQL and have tests of their own
    assert set(registry.QUERIES) <= set(SQL)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["trip_date", "operator", "trips"]
    assert df.count() > 0


def test_sketch_ranks_tell_wrong_quantiles(spark, small):
    rows = trip.measures(Workspace(spark, small).trips())
    sketched = rollups.merged_sketches(rollups.daily_wait_sketches(rows))
    exact = rollups.daily_wait_counts(rows)
    verdicts = lambda df: {(r.wait_p50_within_bound, r.wait_p90_within_bound) for r in df.collect()}
    assert verdicts(rollups.sketch_ranks(sketched, exact)) == {(True, True)}
    # swapped quantiles are outside wherever there are rows enough to tell
    swapped = sketched.where("trips_with_wait >= 20").selectExpr(
        "month", "operator", "trips_with_wait", "wait_p90 AS wait_p50", "wait_p50 AS wait_p90"
    )
    assert verdicts(rollups.sketch_ranks(swapped, exact)) == {(False, False)}
