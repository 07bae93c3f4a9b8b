"""Experiment data: assignment, sessions, funnels, arm summaries and guards.

Users, orders and events may be dominated by a single user, so every step
reduces rows with a map-side aggregate before it moves them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbflow.functions.fixed import ratio

c = F.col

# A quadratic mix modulo a prime, exact in 64 bits.
PRIME = 2147483647
MIX = (48271, 69621)
Z_TWO_SIDED_5 = 1.959964
Z_POWER_80 = 0.841621


# ── assignment ───────────────────────────────────────────────────────────────

def variant(user: Column, salt: int, arms: int = 2) -> Column:
    """Stable arm of a numeric user id; other engines can repeat the arithmetic."""
    x = F.pmod(F.pmod(user.cast("bigint"), F.lit(PRIME)) + salt, F.lit(PRIME))
    for m in MIX:
        x = F.pmod(x * (x + m + salt), F.lit(PRIME))
    return F.pmod(F.shiftright(x, 8), F.lit(arms)).cast("int")


def variant_of_text(user: Column, salt: str, arms: int = 2) -> Column:
    """Stable arm of a text id."""
    return F.pmod(F.xxhash64(F.lit(salt), user), F.lit(arms)).cast("int")


def assign(users: DataFrame, user: str, salt: int, arms: int = 2) -> DataFrame:
    """One row per user with the arm, however often the user occurs."""
    return users.select(user).distinct().withColumn("arm", variant(c(user), salt, arms))


FIRST_MONDAY = "2024-12-30"


def week_index(day: Column) -> Column:
    return F.floor(F.datediff(day, F.to_date(F.lit(FIRST_MONDAY))) / 7).cast("int")


def switchback(measures: DataFrame, zones: DataFrame, **sums: str) -> DataFrame:
    """Zone x hour x week units that alternate on and off by week, with their trips and named SQL sums of them.

    Units without trips are units too. Zones come from the lookup, weeks from
    the first to the last one with trips, so the grid has a known size.
    """
    week = week_index(c("trip_date")).alias("week_index")
    keys = ["pu_location_id", "hour_of_day", "week_index"]
    trips = measures.groupBy("pu_location_id", "hour_of_day", week).agg(
        F.count(F.lit(1)).alias("trips"), *[F.sum(F.expr(x)).alias(k) for k, x in sums.items()]
    )
    first, last = trips.agg(F.min("week_index"), F.max("week_index")).first()
    weeks = F.sequence(F.lit(first), F.lit(last)) if first is not None else F.array().cast("array<int>")
    grid = (
        zones.select(c("location_id").cast("int").alias("pu_location_id")).distinct()
        .select("pu_location_id", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour_of_day"))
        .select("pu_location_id", "hour_of_day", F.explode(weeks).alias("week_index"))
    )
    on = F.pmod(c("week_index") + c("pu_location_id"), F.lit(2)) == 0
    units = grid.join(trips, keys, "left").select(
        *keys, *[F.coalesce(k, F.lit(0)).alias(k) for k in ("trips", *sums)]
    )
    return units.withColumn("arm", F.when(on, "on").otherwise("off"))


def ratio_effect(units: DataFrame, numerator: str, denominator: str) -> DataFrame:
    """A ratio of sums per arm, its error over units, and the difference of "on" to "off".

    Trips of a unit depend on each other, so the units are what varies: with e = y - R x per unit, the variance
    of R = sum(y) / sum(x) is n / (n - 1) * sum(e^2) / sum(x)^2 (delta method). Whole-number sums of y, x and
    their products are all that is taken from the units, in one aggregate; units without trips count.
    """
    y, x = (c(k).cast("decimal(18,0)") for k in (numerator, denominator))
    sums = units.groupBy("arm").agg(
        F.count(F.lit(1)).alias("units"), F.sum(y).alias("y"), F.sum(x).alias("x"),
        F.sum(y * y).alias("yy"), F.sum(x * y).alias("xy"), F.sum(x * x).alias("xx"),
    )
    n, sy, sx, yy, xy, xx = (c(k).cast("double") for k in ("units", "y", "x", "yy", "xy", "xx"))
    r = F.try_divide(sy, sx)
    squares = F.greatest(yy - 2 * r * xy + r * r * xx, F.lit(0.0))
    arms = sums.select(
        "arm", "units", c("y").cast("bigint").alias(numerator), c("x").cast("bigint").alias(denominator),
        r.alias("ratio"), F.sqrt(F.try_divide(n, n - 1) * F.try_divide(squares, sx * sx)).alias("error"),
    )
    both = Window.partitionBy(F.lit(0))  # a row per arm
    off = {k: F.max(F.when(c("arm") == "off", c(k))).over(both) for k in ("ratio", "error")}
    on = c("arm") == "on"
    return arms.select(
        "arm", "units", numerator, denominator, F.round("ratio", 6).alias("ratio"), F.round("error", 8).alias("standard_error"),
        F.when(on, F.round(c("ratio") - off["ratio"], 6)).alias("difference"),
        F.when(on, F.round(F.sqrt(c("error") * c("error") + off["error"] * off["error"]), 8)).alias("difference_error"),
    )


# ── arm summaries ────────────────────────────────────────────────────────────

def user_totals(users: DataFrame, facts: DataFrame, user: str, fact_user: str,
                value_cents: Column) -> DataFrame:
    """Per assigned user the total of a metric, 0 for users without any fact."""
    totals = facts.groupBy(c(fact_user).alias("_user")).agg(
        F.sum(value_cents).alias("value"), F.count(F.lit(1)).alias("facts")
    )
    return users.join(totals, c(user) == c("_user"), "left").select(
        user, "arm", F.coalesce("value", F.lit(0)).alias("value"),
        F.coalesce("facts", F.lit(0)).alias("facts"),
    )


def _moments(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    wide = c(value).cast("decimal(19,0)")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(wide).cast("decimal(28,0)").alias("s1"),
        F.sum(wide * wide).alias("s2"),
    )


def _variance() -> Column:
    """Sample variance from whole-number moments: exact up to the last division.

    Where the products leave 38 digits, the same formula on doubles takes over.
    """
    n, s1, s2 = (c(x).cast("double") for x in ("n", "s1", "s2"))
    squares = F.try_multiply(c("n").try_cast("decimal(13,0)"), c("s2").try_cast("decimal(25,0)"))
    square = F.try_multiply(c("s1").try_cast("decimal(19,0)"), c("s1").try_cast("decimal(19,0)"))
    exact = F.try_divide(F.try_subtract(squares, square).cast("double"), n * (n - 1))
    return F.coalesce(exact, F.try_divide(s2 - s1 * s1 / n, n - 1))


def itt_summary(per_user: DataFrame) -> DataFrame:
    """Arms compared over everybody assigned, in dollars per user."""
    arms = _moments(per_user, ["arm"], "value").select(
        "arm", "n", ratio("s1", "n", 4, unit=100).alias("mean"),
        (_variance() / 10000.0).alias("variance"),
    )
    one = Window.partitionBy(F.lit(0))  # a row per arm
    first = F.max(F.when(c("arm") == 0, c("mean"))).over(one)
    error = F.sqrt(F.max(F.when(c("arm") == 0, c("variance") / c("n"))).over(one)
                   + c("variance") / c("n"))
    return arms.select(
        "arm", "n", "mean", F.round("variance", 2).alias("variance"),
        F.round(c("mean") - first, 4).alias("diff_to_control"),
        F.when(c("arm") != 0, F.round(error, 4)).alias("standard_error"),
    )


def sample_size(measures: DataFrame, effect_pct: int = 3) -> DataFrame:
    """Trips per arm to see a relative change of the mean tip, per operator."""
    z = (Z_TWO_SIDED_5 + Z_POWER_80) ** 2
    base = _moments(measures, ["operator"], "tips").select(
        "operator", "n", "s1", _variance().alias("variance")
    )
    mean = c("s1").cast("double") / c("n").cast("double")
    delta = mean * (effect_pct / 100.0)
    return base.select(
        "operator", c("n").alias("trips"), ratio("s1", "n", 4, unit=100).alias("mean_tip"),
        F.round(F.sqrt("variance") / 100.0, 4).alias("sd_tip"),
        F.when(c("s1") > 0, F.ceil(2 * z * c("variance") / (delta * delta))).alias("n_per_arm"),
    )


def sample_size_of(mean: float, sd: float, effect_pct: float) -> int:
    """The same closed form for figures that are already known."""
    delta = mean * effect_pct / 100
    return ceil(2 * (Z_TWO_SIDED_5 + Z_POWER_80) ** 2 * sd * sd / (delta * delta))


def balance(rows: DataFrame, covariates: Mapping[str, Column], weight: str = "n") -> DataFrame:
    """Share of every level of every covariate in both arms, and their distance.

    ``rows`` carries ``arm`` (0 / 1) and, as ``weight``, how many facts a row
    stands for: facts are best counted per user and level before a join.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("covariate"), level.cast("string").alias("level"))
        for name, level in covariates.items()
    ])).alias("p")
    counts = rows.select("arm", c(weight).alias("w"), pairs).groupBy("p.covariate", "p.level").agg(
        F.sum(F.expr("CASE WHEN arm = 0 THEN w ELSE 0L END")).alias("n_control"),
        F.sum(F.expr("CASE WHEN arm = 1 THEN w ELSE 0L END")).alias("n_test"),
    )
    w = Window.partitionBy("covariate")
    shares = counts.select(
        "*",
        (c("n_control") / F.sum("n_control").over(w)).alias("p0"),
        (c("n_test") / F.sum("n_test").over(w)).alias("p1"),
    )
    spread = F.sqrt((c("p0") * (1 - c("p0")) + c("p1") * (1 - c("p1"))) / 2.0)
    return shares.select(
        "covariate", "level", "n_control", "n_test",
        F.round("p0", 6).alias("share_control"), F.round("p1", 6).alias("share_test"),
        F.round(F.try_divide(c("p1") - c("p0"), spread), 4).alias("std_difference"),
    )


def guardrails(per_user: DataFrame, rules: DataFrame) -> DataFrame:
    """Verdict per protected metric: the test arm may not fall below the floor.

    ``rules``: (metric, max_drop_pct). Metrics: revenue and facts per user, and
    the percentage of users with any fact.
    """
    def per_arm(expr: str, arm: int) -> Column:
        return F.sum(F.expr(f"CASE WHEN arm = {arm} THEN {expr} ELSE 0L END"))

    totals = per_user.agg(*[
        x for arm in (0, 1)
        for x in (
            per_arm("1L", arm).alias(f"n{arm}"), per_arm("value", arm).alias(f"revenue{arm}"),
            per_arm("facts", arm).alias(f"facts{arm}"),
            per_arm("CAST(facts > 0 AS BIGINT)", arm).alias(f"active{arm}"),
        )
    ])
    # metric: (total, factor, scale of the total)
    metrics = {"revenue_per_user": ("revenue", 1, 100), "orders_per_user": ("facts", 1, 1),
               "active_users_pct": ("active", 100, 1)}
    figures = F.explode(F.array(*[
        F.struct(
            F.lit(name).alias("metric"),
            *[ratio(f"{col}{a}", f"n{a}", 4, times=times, unit=unit).alias(label)
              for a, label in ((0, "control"), (1, "test"))],
        )
        for name, (col, times, unit) in metrics.items()
    ])).alias("f")
    floor = c("control") * (1 - c("max_drop_pct") / 100.0)
    return totals.select(figures).select("f.*").join(rules, "metric").select(
        "metric", "control", "test", "max_drop_pct",
        F.when(c("test") >= floor, "ok").otherwise("violated").alias("verdict"),
    )


# ── sessions and funnels ─────────────────────────────────────────────────────

def sessions(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """A user's events become sessions where the pause exceeds ``gap_minutes``.

    Events of one user inside a slot as long as the gap always belong together,
    so they are first folded to (first, last, count) per slot on the map side.
    What is ordered per user afterwards grows with time covered, not with rows.
    """
    gap = gap_minutes * 60 * 1_000_000
    micros = (c("ts") - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")).cast(
        "interval second"
    ).cast("decimal(20,6)") * 1_000_000
    slots = (
        events.select("user_id", "ts", micros.cast("bigint").alias("us"))
        .groupBy("user_id", F.expr(f"us div {gap}L").alias("slot"))
        .agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"),
             F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
             F.count(F.lit(1)).alias("events"))
    )
    w = Window.partitionBy("user_id").orderBy("slot")
    starts = F.coalesce(c("first_us") - F.lag("last_us").over(w) > gap, F.lit(True))
    marked = slots.withColumn("starts", starts.cast("int"))
    numbered = marked.withColumn("session", F.sum("starts").over(w))
    return numbered.groupBy("user_id", "session").agg(
        F.min("first_ts").alias("session_start"), F.max("last_ts").alias("session_end"),
        F.sum("events").alias("events"),
    )


def funnel(events: DataFrame, steps: Sequence[str]) -> DataFrame:
    """Users who do the steps in order: each step at or after the earliest way through the one before.

    A user's times of a step are reduced to distinct ones before they move, and
    only the earliest that follows is kept, so a busy user stays small.
    """
    times = events.where(c("event_type").isin(*steps)).groupBy("user_id", "event_type", "ts").agg(F.lit(1).alias("one"))
    reached, counts = None, []
    for i, step in enumerate(steps):
        here = times.where(c("event_type") == step).select("user_id", "ts")
        if reached is not None:
            here = here.join(reached, "user_id").where(c("ts") >= c("reached"))
        reached = here.groupBy("user_id").agg(F.min("ts").alias("reached"))
        counts.append(reached.agg(
            F.lit(i + 1).alias("step_order"), F.lit(step).alias("step"), F.count(F.lit(1)).alias("users")
        ))
    rows = reduce(DataFrame.unionByName, counts)
    w = Window.orderBy("step_order")  # a row per step
    return rows.select(
        "step_order", "step", "users",
        F.coalesce(F.lag("users").over(w), c("users")).alias("previous"), F.first("users").over(w).alias("entered"),
    ).select(
        "step_order", "step", "users",
        ratio("users", "previous", 4, times=100).alias("from_previous_pct"),
        ratio("users", "entered", 4, times=100).alias("from_first_pct"),
    )


# ── excluded days ────────────────────────────────────────────────────────────

# Storms and the December season, declared before a test.
STORM_DAYS = ["2026-01-25", "2026-02-23"]
EXCLUDED_MONTH = ("2025-12-01", "2025-12-31")


def excluded_days(spark) -> DataFrame:
    """(trip_date, reason): a few dozen dates."""
    storms = ", ".join(f"DATE'{d}'" for d in STORM_DAYS)
    return spark.sql(f"""
        SELECT explode(array({storms})) AS trip_date, 'storm' AS reason
        UNION ALL
        SELECT explode(sequence(DATE'{EXCLUDED_MONTH[0]}', DATE'{EXCLUDED_MONTH[1]}')), 'season'
    """)


def exclude_days(measures: DataFrame, days: DataFrame) -> DataFrame:
    """Daily trips and tips on the days that stay in the analysis."""
    return measures.join(days, "trip_date", "left_anti").groupBy("trip_date", "operator").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("tips").alias("s_tips")
    ).select("trip_date", "operator", "trips", ratio("s_tips", "trips", 4, unit=100).alias("avg_tip"))
