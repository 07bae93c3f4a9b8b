"""Assignment, sessions, funnels and arm figures against brute force."""

import datetime as dt
import random
import statistics
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from curbflow.operators import experiments as x

START = dt.datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame(rows, "user_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING")


def random_events(seed, hot_share):
    """Events of a few users; user 0 holds about ``hot_share`` of them."""
    rnd = random.Random(seed)
    out = []
    for _ in range(3000):
        user = 0 if rnd.random() < hot_share else rnd.randrange(1, 40)
        second = rnd.randrange(0, 20 * 86400)
        out.append((user, START + dt.timedelta(seconds=second, microseconds=rnd.randrange(10**6)),
                    rnd.choice(["view", "click", "signup", "purchase", "error"])))
    return out


def test_variant_is_stable_and_balanced(spark):
    arms = spark.range(20000).select("id", x.variant(F.col("id"), 17).alias("arm")).collect()
    again = spark.range(20000).repartition(7).select("id", x.variant(F.col("id"), 17).alias("arm"))
    assert {r.id: r.arm for r in arms} == {r.id: r.arm for r in again.collect()}
    assert abs(sum(r.arm for r in arms) / 20000 - 0.5) < 0.02
    other = spark.range(20000).select(x.variant(F.col("id"), 18).alias("arm")).collect()
    agree = sum(a.arm == b.arm for a, b in zip(arms, other)) / 20000
    assert 0.4 < agree < 0.6
    text = spark.range(2000).select(
        x.variant_of_text(F.concat(F.lit("p"), "id"), "s", 4).alias("a")).collect()
    assert set(r.a for r in text) == {0, 1, 2, 3}


def test_one_arm_per_user(spark):
    users = spark.createDataFrame([(i % 10,) for i in range(100)], "u BIGINT")
    assert x.assign(users, "u", 3).count() == 10


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_match_brute_force_with_a_hot_user(spark, seed):
    rows = random_events(seed, 1 / 3)
    want = set()
    by_user = defaultdict(list)
    for user, ts, _ in rows:
        by_user[user].append(ts)
    for user, times in by_user.items():
        times.sort()
        current = [times[0]]
        number = 1
        for t in times[1:]:
            if t - current[-1] > dt.timedelta(minutes=30):
                want.add((user, number, current[0], current[-1], len(current)))
                number, current = number + 1, []
            current.append(t)
        want.add((user, number, current[0], current[-1], len(current)))
    got = {tuple(r) for r in x.sessions(events(spark, rows)).collect()}
    assert got == want


def test_session_pause_boundary(spark):
    at = [START, START + dt.timedelta(minutes=30), START + dt.timedelta(minutes=60, microseconds=1)]
    got = x.sessions(events(spark, [(1, t, "view") for t in at])).orderBy("session").collect()
    assert [r.events for r in got] == [2, 1]


def test_funnel_matches_brute_force(spark):
    rows = random_events(5, 1 / 3)
    steps = ["view", "click", "signup", "purchase"]
    rows += [(777, START + dt.timedelta(minutes=m), k) for m, k in enumerate(["click", "view", "click", "view", "signup"])]
    at = defaultdict(int)
    reached = Counter()
    for user, _, kind in sorted(rows, key=lambda r: (r[0], r[1], steps.index(r[2]) if r[2] in steps else 9)):
        if at[user] < len(steps) and kind == steps[at[user]]:
            reached[kind] += 1
            at[user] += 1
    got = {r.step: r.users for r in x.funnel(events(spark, rows), steps).collect()}
    assert got == {s: reached[s] for s in steps}


def test_itt_keeps_users_without_facts(spark):
    users = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1)], "u BIGINT, arm INT")
    facts = spark.createDataFrame([(1, 10.0), (1, 20.0), (3, 50.5)], "f BIGINT, amount DOUBLE")
    per_user = x.user_totals(users, facts, "u", "f", F.rint(F.col("amount") * 100).cast("bigint"))
    r = {r.arm: r for r in x.itt_summary(per_user).collect()}
    assert (r[0].n, r[0].mean, r[1].mean) == (2, 15.0, 25.25)
    assert r[0].variance == statistics.variance([30.0, 0.0])
    assert r[1].diff_to_control == 10.25
    assert r[1].standard_error == round((450 / 2 + statistics.variance([50.5, 0]) / 2) ** 0.5, 4)


def test_variance_beyond_64_bits(spark):
    n = 10**12
    row = spark.createDataFrame([(n, Decimal(500 * n), Decimal(300_000 * n))], "n BIGINT, s1 DECIMAL(28,0), s2 DECIMAL(38,0)")
    assert row.select(x._variance()).first()[0] == pytest.approx(50_000.0)
    row = spark.createDataFrame([(n, Decimal(10**9 * n), Decimal(2 * 10**18 * n))], "n BIGINT, s1 DECIMAL(28,0), s2 DECIMAL(38,0)")
    assert row.select(x._variance()).first()[0] == pytest.approx(1e18, rel=1e-6)


def test_sample_size_grows_with_spread():
    assert x.sample_size_of(10, 5, 5) == 1570
    assert x.sample_size_of(10, 10, 5) > x.sample_size_of(10, 5, 5)


def test_switchback_alternates(spark):
    days = [dt.date(2025, 6, 2) + dt.timedelta(weeks=i) for i in range(4)]
    m = spark.createDataFrame([(7, 4, d) for d in days], "pu_location_id INT, hour_of_day INT, trip_date DATE")
    lookup = spark.createDataFrame([(7,), (8,)], "location_id INT")
    units = x.switchback(m, lookup)
    assert units.count() == 2 * 24 * 4 and units.where("trips = 0").count() == 2 * 24 * 4 - 4
    arms = [r.arm for r in units.where("pu_location_id = 7 AND hour_of_day = 4").orderBy("week_index").collect()]
    assert arms in (["on", "off", "on", "off"], ["off", "on", "off", "on"])


def test_excluded_days(spark):
    days = {r.trip_date for r in x.excluded_days(spark).collect()}
    assert len(days) == 33 and dt.date(2026, 1, 25) in days and dt.date(2025, 12, 31) in days


def test_guardrail_verdicts(spark):
    per_user = spark.createDataFrame(
        [(0, 1000, 1), (0, 1000, 1), (1, 900, 1), (1, 900, 2)], "arm INT, value BIGINT, facts BIGINT")
    rules = spark.createDataFrame(
        [("revenue_per_user", 5), ("orders_per_user", 5), ("active_users_pct", 0)],
        "metric STRING, max_drop_pct INT")
    got = {r.metric: r.verdict for r in x.guardrails(per_user, rules).collect()}
    assert got == {"revenue_per_user": "violated", "orders_per_user": "ok", "active_users_pct": "ok"}
