"""Coarser figures from marts: shares as ratios of sums, and dashboard reports.

Published sums are dollars and miles; they go back to whole cents before they
are added up, so the result does not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbflow.functions import trip as t
from curbflow.functions.fixed import CENTS, MILLI, cents, dollars, ratio
from curbflow.functions.grouping import ROWS, fold, rows_where, with_quantiles
from curbflow.plans.marts import COHORTS, WAIT_QUANTILES, airport_ends

c = F.col


def _month() -> Column:
    return F.trunc("trip_date", "MM").alias("month")


def _sum(name: str) -> Column:
    return F.sum(name).alias(name)


def _sum_cents(name: str, alias: str) -> Column:
    return F.sum(cents(name)).alias(alias)


def _pct(num: str, den: str, digits: int = 4) -> Column:
    return ratio(num, den, digits, times=100)


def rounded_quantiles(
    folded: DataFrame, keys: list[str], *others: Column,
    value: str = "wait", quantiles: Mapping[str, float] = WAIT_QUANTILES,
) -> DataFrame:
    """Quantiles of folded rows to one digit, beside other aggregates."""
    return with_quantiles(folded, keys, others, value, quantiles).withColumns(
        {n: F.round(n, 1) for n in quantiles}
    )


def _late(seconds: int) -> Column:
    return F.sum(F.expr(rows_where(f"wait > {seconds}")))


def waits_with_quantiles(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Valid waits per group: count, exact p50 / p90, long waits."""
    return rounded_quantiles(
        fold(rows.where(c("wait").isNotNull()), keys, {}, "wait"), keys,
        F.sum(ROWS).alias("trips_with_wait"),
        _late(t.LONG_WAIT_SECONDS).alias("wait_gt10"),
        _late(t.VERY_LONG_WAIT_SECONDS).alias("wait_gt15"),
    )


# ── re-aggregation ───────────────────────────────────────────────────────────

def price_ratios(pricing: DataFrame) -> DataFrame:
    """Monthly shares recomputed from the sums beside the daily shares."""
    sums = pricing.groupBy(_month(), "operator").agg(
        _sum_cents("sum_base_fare", "base"), _sum_cents("sum_total_fare", "total"),
        _sum_cents("sum_tips", "tips"), _sum_cents("sum_driver_pay", "pay"), _sum("trips"),
    )
    return sums.select(
        "month", "operator", "trips",
        ratio("tips", "base", 4).alias("tip_rate_on_fare"),
        ratio("pay", "base", 4).alias("driver_pay_ratio"),
        ratio("total", "trips", 2, unit=CENTS).alias("avg_total_fare"),
    )


def bias_report(measures: DataFrame, pricing: DataFrame) -> DataFrame:
    """How far a mean of ratios is from the ratio of sums, per operator.

    Fare per mile is averaged over trips, the tip rate over days.
    """
    # per-trip ratio in ten-thousandths of a dollar per mile; none for a distance that rounds to zero
    per_trip = F.expr("CASE WHEN milli <> 0 THEN (base * 100000L) div milli END")
    fares = measures.groupBy("operator").agg(
        F.count(per_trip).alias("trips"), F.sum(per_trip).alias("ratios"),
        F.sum("base").alias("base"), F.sum("milli").alias("milli"),
    )
    days = pricing.groupBy("operator").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum(F.rint(c("tip_rate_on_fare") * 10000).cast("bigint")).alias("rates"),
        _sum_cents("sum_tips", "tips"), _sum_cents("sum_base_fare", "day_base"),
    )
    return fares.join(days, "operator").select(
        "operator",
        ratio("ratios", "trips", 2, unit=10000).alias("fare_per_mile_mean_of_ratios"),
        ratio("base", "milli", 2, times=10).alias("fare_per_mile_ratio_of_sums"),
        ratio("rates", "days", 4, unit=10000).alias("tip_rate_mean_of_days"),
        ratio("tips", "day_base", 4).alias("tip_rate_ratio_of_sums"),
    ).withColumns({
        "fare_per_mile_bias_pct": _bias("fare_per_mile_mean_of_ratios",
                                        "fare_per_mile_ratio_of_sums", 100),
        "tip_rate_bias_pct": _bias("tip_rate_mean_of_days", "tip_rate_ratio_of_sums", 10000),
    })


def _bias(wrong: str, right: str, scale: int) -> Column:
    a, b = (f"CAST(rint({x} * {scale}) AS BIGINT)" for x in (wrong, right))
    return _pct(f"{a} - {b}", b, 2)


def cohort_waits(daily: DataFrame) -> DataFrame:
    """Monthly mean wait of each cohort: sum of seconds over trips with a wait."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(k).alias("cohort"), c(f"{k}_trips_with_wait").alias("n"),
                 c(f"{k}_sum_wait_sec").alias("s"))
        for k in COHORTS
    ])).alias("p")
    long = daily.select("trip_date", "operator", pairs).select("trip_date", "operator", "p.*")
    return long.groupBy(_month(), "operator", "cohort").agg(
        F.sum("n").alias("trips_with_wait"), F.sum("s").alias("sum_wait_sec")
    ).withColumn("avg_wait_sec", ratio("sum_wait_sec", "trips_with_wait", 2))


def daily_wait_counts(measures: DataFrame) -> DataFrame:
    """Exact mergeable form of the daily waiting distribution."""
    return fold(measures.where(c("wait").isNotNull()), ["trip_date", "operator"], {}, "wait")


def merged_quantiles(daily_counts: DataFrame) -> DataFrame:
    """Monthly quantiles from daily value counts: exact, nothing is averaged."""
    monthly = daily_counts.groupBy(_month(), "operator", "wait").agg(_sum(ROWS))
    return rounded_quantiles(monthly, ["month", "operator"], F.sum(ROWS).alias("trips_with_wait"))


def wait_states(measures: DataFrame, keys: list[str]) -> DataFrame:
    """Per group the trips with a wait and a small mergeable sketch of their waits, from one shuffle."""
    return measures.where(c("wait").isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trips_with_wait"),
        F.expr("kll_sketch_agg_bigint(wait)").alias("sketch"),
    )


#: States that gold keeps beside its marts: the mart, its keys, and the rows they group.
STATES = {
    "mart_overview_daily": (["trip_date", "operator"], lambda rows: rows),
    "mart_pickup_zones": (["trip_date", "pu_location_id", "operator"], lambda rows: rows),
    "mart_airports": (["month", "airport", "direction", "operator"], airport_ends),
}


def mart_state(name: str, measures: DataFrame) -> DataFrame:
    """The mergeable state of a mart's waiting times: any coarser report is a merge of its rows."""
    keys, rows = STATES[name]
    return wait_states(rows(measures), keys)


def daily_wait_sketches(measures: DataFrame) -> DataFrame:
    """Small mergeable sketches of the daily waits, for values without a bound."""
    return wait_states(measures, ["trip_date", "operator"])


def merged_sketches(states: DataFrame, keys: tuple[str, ...] = ("month", "operator")) -> DataFrame:
    """Approximate quantiles of coarser groups from merged states; months come from dates where there is none."""
    rows = states.withColumn("month", _month()) if "month" in keys and "month" not in states.columns else states
    return rows.groupBy(*keys).agg(
        _sum("trips_with_wait"), F.expr("kll_merge_agg_bigint(sketch)").alias("sketch")
    ).select(
        *keys, "trips_with_wait",
        *[F.expr(f"kll_sketch_get_quantile_bigint(sketch, {q}D)").alias(n)
          for n, q in WAIT_QUANTILES.items()],
    )


#: Rank error of a sketched quantile that its report allows, as a share of the rows;
#: a sketch of the default size stays within 0.0133 in 99 of 100 cases.
RANK_ERROR = 0.03


def sketch_ranks(sketched: DataFrame, daily_counts: DataFrame) -> DataFrame:
    """Whether each sketched quantile's exact rank lies within ``RANK_ERROR`` of what was asked for."""
    return ranks_of(sketched, daily_counts.groupBy(_month(), "operator", "wait").agg(_sum(ROWS)), ["month", "operator"])


def ranks_of(sketched: DataFrame, exact: DataFrame, keys: list[str]) -> DataFrame:
    """The same for any groups, against their exact counts per wait."""
    both = exact.join(sketched.drop("trips_with_wait"), keys)  # a sketch row per group
    below = [
        F.sum(F.when(c("wait") < c(n), c(ROWS)).otherwise(0)).alias(f"{n}_below") for n in WAIT_QUANTILES
    ]
    upto = [
        F.sum(F.when(c("wait") <= c(n), c(ROWS)).otherwise(0)).alias(f"{n}_upto") for n in WAIT_QUANTILES
    ]
    ranks = both.groupBy(*keys).agg(F.sum(ROWS).alias("total"), *below, *upto)

    def holds(name: str, q: float) -> Column:
        # a value covers the ranks of all its rows; one row more or less is no error
        slack = RANK_ERROR * c("total") + 1
        return (
            (c(f"{name}_below") <= q * c("total") + slack) & (c(f"{name}_upto") >= q * c("total") - slack)
        ).alias(f"{name}_within_bound")

    return sketched.select(*keys, "trips_with_wait").join(ranks, keys).select(
        *keys, "trips_with_wait", *[holds(n, q) for n, q in WAIT_QUANTILES.items()]
    )


# ── dashboard reports ────────────────────────────────────────────────────────

def market_share(overview: DataFrame) -> DataFrame:
    monthly = overview.groupBy(_month(), "operator").agg(_sum("trips"))
    total = F.sum("trips").over(Window.partitionBy("month"))
    return monthly.withColumn("month_trips", total).withColumn(
        "share_pct", _pct("trips", "month_trips")
    )


def demand_profile(hourly: DataFrame) -> DataFrame:
    """Trips by hour and by weekday, with the peak and the minimum marked."""
    def by(column: str, name: str) -> DataFrame:
        return hourly.groupBy(c(column).alias("slot")).agg(_sum("trips")).select(
            F.lit(name).alias("profile"), "slot", "trips"
        )

    both = by("hour_of_day", "hour").unionByName(by("day_of_week", "weekday"))
    w = Window.partitionBy("profile")
    return both.select(
        "profile", "slot", "trips",
        (c("trips") == F.max("trips").over(w)).alias("is_peak"),
        (c("trips") == F.min("trips").over(w)).alias("is_minimum"),
    )


def event_day_change(overview: DataFrame, weeks: int = 4) -> DataFrame:
    """Each date against the mean of the same weekday in the preceding weeks.

    The weeks are those before the date, by the calendar; dates for which not
    all of them have trips stay, with the weeks there are and no comparison.
    """
    daily = overview.groupBy("trip_date").agg(_sum("trips")).withColumns({
        "day_of_week": t.day_of_week(c("trip_date")),
        "day": F.datediff("trip_date", F.to_date(F.lit("2000-01-03"))),
    })
    w = Window.partitionBy("day_of_week").orderBy("day").rangeBetween(-7 * weeks, -7)
    normal = daily.select(
        "trip_date", "day_of_week", "trips",
        F.sum("trips").over(w).alias("before"), F.count("trips").over(w).cast("int").alias("weeks"),
    )
    full = c("weeks") == weeks
    return normal.select(
        "trip_date", "day_of_week", "trips", "weeks",
        F.when(full, ratio("before", "weeks", 2)).alias("normal_trips"),
        F.when(full, _pct("trips * weeks - before", "before", 2)).alias("change_pct"),
    )


def kpi_summary(measures: DataFrame) -> DataFrame:
    folded = fold(measures, [], {"total": "total", "milli": "milli", "secs": "secs"}, "wait")
    n_wait = F.sum(F.when(c("wait").isNotNull(), c(ROWS)).otherwise(F.lit(0)))
    sums = rounded_quantiles(
        folded, [], F.sum(ROWS).alias("trips"), n_wait.alias("trips_with_wait"),
        _late(t.LONG_WAIT_SECONDS).alias("late"), _sum("total"), _sum("milli"), _sum("secs"),
    )
    return sums.select(
        "trips", "trips_with_wait", "wait_p50", "wait_p90",
        _pct("late", "trips_with_wait").alias("wait_gt10_pct"),
        ratio("total", "trips", 2, unit=CENTS).alias("avg_fare"),
        ratio("milli", "trips", 3, unit=MILLI).alias("avg_distance_miles"),
        ratio("secs", "trips", 2, unit=60).alias("avg_duration_min"),
    )


def wait_by_borough(measures: DataFrame, zones: DataFrame) -> DataFrame:
    """Waiting by pickup borough; zones are folded first, names joined after."""
    folded = fold(measures.where(c("wait").isNotNull()), ["pu_location_id"], {}, "wait")
    dim = zones.select("location_id", c("borough").alias("pu_borough"))
    named = folded.join(dim, c("pu_location_id") == c("location_id"), "left")
    # most zones fold into few boroughs: one row per borough and second again
    by_value = named.groupBy("pu_borough", "wait").agg(_sum(ROWS))
    return rounded_quantiles(by_value, ["pu_borough"], F.sum(ROWS).alias("trips_with_wait"))


def worst_wait_slots(measures: DataFrame) -> DataFrame:
    """Weekday and hour slots (168 at most) ranked by their p90 wait."""
    slots = waits_with_quantiles(measures, ["day_of_week", "hour_of_day"])
    rank = F.dense_rank().over(Window.orderBy(c("wait_p90").desc()))
    return slots.select("day_of_week", "hour_of_day", "trips_with_wait", "wait_p50", "wait_p90",
                        rank.cast("int").alias("wait_rank"))


def wav_fulfilment(daily: DataFrame) -> DataFrame:
    sums = daily.groupBy("operator").agg(
        _sum("trips"), _sum("wav_requests"), _sum("wav_requested_matches"), _sum("actual_wav_trips")
    )
    return sums.select(
        "operator", "wav_requests",
        _pct("wav_requests - wav_requested_matches", "wav_requests").alias("unfulfilled_pct"),
        _pct("wav_requests", "trips").alias("explicit_demand_pct"),
        _pct("actual_wav_trips", "trips").alias("actual_wav_pct"),
    )


def shared_funnel(daily: DataFrame) -> DataFrame:
    sums = daily.groupBy(_month()).agg(
        _sum("trips"), _sum("shared_requests"), _sum("shared_requested_matches"),
        _sum("actual_shared_trips"),
    )
    return sums.select(
        "month", "trips", "shared_requests",
        _pct("shared_requests", "trips").alias("request_rate_pct"),
        _pct("shared_requested_matches", "shared_requests").alias("match_conversion_pct"),
        _pct("actual_shared_trips", "trips").alias("actual_shared_pct"),
    )


def orphans_by_operator(daily: DataFrame) -> DataFrame:
    return daily.groupBy("operator").agg(
        _sum("shared_orphan_matches"), _sum("actual_shared_trips")
    ).withColumn("orphan_pct", _pct("shared_orphan_matches", "actual_shared_trips"))


def pay_ratio_range(pricing: DataFrame) -> DataFrame:
    monthly = price_ratios(pricing)
    return monthly.groupBy("operator").agg(
        F.min("driver_pay_ratio").alias("min_ratio"), F.max("driver_pay_ratio").alias("max_ratio"),
        F.min_by("month", F.struct("driver_pay_ratio", "month")).alias("min_month"),
        F.max_by("month", F.struct("driver_pay_ratio", "month")).alias("max_month"),
    )


def tip_shares(pricing: DataFrame) -> DataFrame:
    """The three tip shares, each over its own denominator."""
    sums = pricing.groupBy(_month()).agg(
        _sum_cents("sum_base_fare", "base"), _sum_cents("sum_total_fare", "total"),
        _sum_cents("sum_tips", "tips"),
    )
    return sums.select(
        "month", dollars("tips").alias("sum_tips"),
        ratio("tips", "base", 4).alias("tip_rate_on_fare"),
        ratio("tips", "total", 4).alias("tips_to_charges"),
        ratio("tips", "total + tips", 4).alias("tips_share_of_paid"),
    )


