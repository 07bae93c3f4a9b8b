"""Baseline figures for product hypotheses: tips, waiting, pay, airports, zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbflow.functions import trip as t
from curbflow.functions.fixed import CENTS, dollars, ratio
from curbflow.functions.grouping import ROWS, fold, rows_where, tally, with_quantiles
from curbflow.operators.experiments import week_index
from curbflow.plans.marts import airport_ends
from curbflow.plans.rollups import rounded_quantiles, waits_with_quantiles

c = F.col

# Parameters the hypotheses state.
LARGE_TIP_CENTS = 500
ROUND_TO_CENTS = 50
SHOWN_FROM_CENTS = 10
PAY_FLOOR_FROM = "2026-03-01"
# driver pay floor in 1e-4 cents: $0.681 per minute, $1.283 per mile
FLOOR_PER_SECOND = 11350
FLOOR_PER_MILLI = 1283
EVENING_HOURS = (22, 23)


def _pct(num: str, den: str, digits: int = 4) -> Column:
    return ratio(num, den, digits, times=100)


def _count(cond: str) -> Column:
    return F.sum(F.expr(tally(cond)))


def _weighted(cond: str) -> Column:
    return F.sum(F.expr(rows_where(cond)))


def tips(measures: DataFrame) -> DataFrame:
    """Mean tip of all trips, share tipped, and the giving customers' habits."""
    # tips repeat (whole cents), so the distinct values are few
    by_value = measures.groupBy("tips").agg(F.count(F.lit(1)).alias(ROWS))
    given = F.when(c("tips") > 0, c("tips"))
    sums = with_quantiles(
        by_value.withColumn("given", given), [], [
            F.sum(ROWS).alias("trips"), F.sum(c("tips") * c(ROWS)).alias("total"),
            _weighted("tips > 0").alias("tipped"),
            _weighted(f"tips > 0 AND tips < {LARGE_TIP_CENTS}").alias("small"),
            _weighted(f"tips >= {LARGE_TIP_CENTS}").alias("large"),
        ], "given", {"median": 0.5},
    )
    return sums.select(
        "trips", ratio("total", "trips", 4, unit=CENTS).alias("avg_tip"),
        _pct("tipped", "trips").alias("tipped_pct"),
        (F.bround(F.round("median", 6), 0) / 100.0).alias("median_tip_of_givers"),
        _pct("small", "tipped").alias("under_5_pct"), _pct("large", "tipped").alias("from_5_pct"),
    )


def roundup(measures: DataFrame, conversions_pct: tuple[int, ...] = (15, 30, 100)) -> DataFrame:
    """Offer to round the bill up to the next half dollar as a tip.

    Shown to trips tipped below five dollars whose gap is at least ten cents;
    one row per assumed conversion.
    """
    gap = f"pmod({ROUND_TO_CENTS}L - total % {ROUND_TO_CENTS}L, {ROUND_TO_CENTS}L)"
    rows = measures.select("tips", F.expr(gap).alias("gap"))
    open_to = f"tips < {LARGE_TIP_CENTS}"
    shown = f"{open_to} AND gap >= {SHOWN_FROM_CENTS}"
    sums = rows.agg(
        F.count(F.lit(1)).alias("trips"), F.sum("tips").alias("tips"),
        _count(open_to).alias("eligible"),
        _count(f"{open_to} AND gap = 0").alias("round_already"),
        _count(f"{open_to} AND gap BETWEEN 1 AND {SHOWN_FROM_CENTS - 1}").alias("too_small"),
        _count(shown).alias("shown"),
        F.sum(F.expr(f"CASE WHEN {shown} THEN gap ELSE 0L END")).alias("extra"),
    )
    rates = F.explode(F.array(*[F.lit(x).cast("bigint") for x in conversions_pct]))
    return sums.withColumn("conversion_pct", rates).select(
        "conversion_pct", "trips", "eligible",
        _pct("round_already", "eligible").alias("round_already_pct"),
        _pct("too_small", "eligible").alias("too_small_pct"),
        _pct("shown", "eligible").alias("shown_pct"),
        ratio("extra", "shown", 4, unit=CENTS).alias("avg_extra"),
        ratio("extra * conversion_pct", "tips", 4).alias("tips_uplift_pct"),
    )


def tips_by_month(measures: DataFrame) -> DataFrame:
    """Mean tip of each month against all months other than December."""
    monthly = measures.groupBy("month").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("tips").alias("tips"),
        _count("tips > 0").alias("tipped"),
    )
    usual = F.month("month") != 12
    everything = Window.partitionBy(F.lit(0))  # a row per month
    based = monthly.select(
        "*",
        F.sum(F.when(usual, c("tips"))).over(everything).alias("base_tips"),
        F.sum(F.when(usual, c("trips"))).over(everything).alias("base_trips"),
    )
    expected = "CAST(base_tips AS DECIMAL(19,0)) * CAST(trips AS DECIMAL(18,0))"
    actual = "CAST(tips AS DECIMAL(19,0)) * CAST(base_trips AS DECIMAL(18,0))"
    return based.select(
        "month", "trips", ratio("tips", "trips", 4, unit=CENTS).alias("avg_tip"),
        _pct("tipped", "trips").alias("tipped_pct"),
        _pct(f"({actual} - {expected})", expected, 2).alias("lift_pct"),
    )


def _wait_columns() -> list[Column | str]:
    return ["trips_with_wait", "wait_p50", "wait_p90",
            _pct("wait_gt15", "trips_with_wait").alias("wait_gt15_pct")]


def wait_by_hour(measures: DataFrame) -> DataFrame:
    return waits_with_quantiles(measures, ["hour_of_day"]).select("hour_of_day", *_wait_columns())


def busy_hour_pay(measures: DataFrame) -> DataFrame:
    """Driver pay per hour with a passenger."""
    return measures.groupBy("hour_of_day").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("pay").alias("pay"), F.sum("secs").alias("secs")
    ).select(
        "hour_of_day", "trips",
        ratio("pay", "secs", 2, times=36).alias("pay_per_busy_hour"),
    )


def pay_floor_gap(measures: DataFrame) -> DataFrame:
    """Driver pay against the minimum per minute and mile, since it applies."""
    floor = c("secs") * FLOOR_PER_SECOND + c("milli") * FLOOR_PER_MILLI
    gap = c("pay") * 10000 - floor
    rows = measures.where(c("trip_date") >= F.to_date(F.lit(PAY_FLOOR_FROM))).select(
        "month", "operator", gap.alias("gap")
    )
    return rows.groupBy("month", "operator").agg(
        F.count(F.lit(1)).alias("trips"), _count("gap < 0").alias("below"),
        F.sum(c("gap").cast("decimal(28,0)")).alias("gap"),
    ).select(
        "month", "operator", "trips", _pct("below", "trips").alias("below_floor_pct"),
        ratio("gap", "trips", 2, unit=1_000_000).alias("avg_gap"),
    )


def scheduled_share(measures: DataFrame) -> DataFrame:
    """Scheduled rides by hour and by relation to an airport."""
    kind = (
        F.when(t.is_airport(c("do_location_id")), "to airport")
        .when(t.is_airport(c("pu_location_id")), "from airport").otherwise("city")
    )
    return measures.groupBy("hour_of_day", kind.alias("direction")).agg(
        F.count(F.lit(1)).alias("trips"), _count("wait_sec < 0").alias("scheduled_rides")
    ).withColumn("scheduled_pct", _pct("scheduled_rides", "trips"))


def zone_hour_wait(measures: DataFrame) -> DataFrame:
    return waits_with_quantiles(measures, ["pu_location_id", "hour_of_day"]).select(
        "pu_location_id", "hour_of_day", *_wait_columns()
    )


def deficit_zones(
    measures: DataFrame, zones: DataFrame, *, p90_over: float, min_trips: int,
    min_months: int, top: int = 8,
) -> DataFrame:
    """Zones with the most hours of lasting long waits and enough volume.

    An hour of a zone lasts when in at least ``min_months`` months it has
    ``min_trips`` trips and a p90 above ``p90_over``.
    """
    cells = waits_with_quantiles(measures, ["pu_location_id", "hour_of_day", "month"]).where(
        (c("trips_with_wait") >= min_trips) & (c("wait_p90") > p90_over)
    )
    hours = cells.groupBy("pu_location_id", "hour_of_day").agg(
        F.count(F.lit(1)).alias("months"), F.sum("trips_with_wait").alias("trips")
    ).where(c("months") >= min_months)
    scored = hours.groupBy("pu_location_id").agg(
        F.count(F.lit(1)).alias("deficit_hours"), F.sum("trips").alias("trips")
    )
    # at most one row per zone is left, so a total order over them is small
    order = Window.orderBy(c("deficit_hours").desc(), c("trips").desc(), "pu_location_id")
    best = scored.withColumn("zone_rank", F.row_number().over(order)).where(
        c("zone_rank") <= top
    )
    names = zones.select("location_id", c("zone").alias("zone_name"), "borough")
    return best.join(names, c("pu_location_id") == c("location_id"), "left").drop("location_id")


def _tried(trials: DataFrame) -> DataFrame:
    """Offers, responses, bonus and margin (hundredths of a cent) per zone, hour and tried rate."""
    return trials.groupBy("pu_location_id", "hour_of_day", "rate_pct").agg(
        F.count(F.lit(1)).alias("offers"), _count("responded").alias("responses"),
        F.sum(F.expr("CASE WHEN responded THEN pay * rate_pct ELSE 0L END")).alias("bonus"),
        F.sum(F.expr("CASE WHEN responded THEN margin * 100 ELSE 0L END")).alias("margin"),
    )


def bonus_rates(trials: DataFrame, target_pct: int) -> DataFrame:
    """The smallest tried bonus per zone and hour that drivers answer and that pays.

    ``trials``: one row per offer with pu_location_id, hour_of_day, rate_pct,
    responded (boolean), pay and margin of the resulting trip in cents. A rate
    qualifies when the response reaches ``target_pct`` and the margin of the
    answered offers exceeds the bonus paid for them.
    """
    fits = (c("responses") * 100 >= c("offers") * target_pct) & (c("margin") > c("bonus"))
    first = F.min_by(F.struct("rate_pct", "offers", "responses", "bonus", "margin"), c("rate_pct"))
    return _tried(trials).where(fits).groupBy("pu_location_id", "hour_of_day").agg(first.alias("b")).select(
        "pu_location_id", "hour_of_day", "b.rate_pct", "b.offers", "b.responses",
        ratio("b.bonus", "1", 2, unit=10000).alias("bonus_paid"),
        ratio("b.margin", "1", 2, unit=10000).alias("margin_earned"),
    )


def response_curves(trials: DataFrame, target_pct: int) -> DataFrame:
    """Response over rate per zone and hour, fitted so that it never falls, and the rate it recommends.

    Few offers at a rate make a raw response jump; what a higher bonus answers can't be less. The fit is the
    least-squares one (pool adjacent violators): at each rate the greatest over lower ends of the least over upper
    ends of the pooled response between. ``chosen`` is the smallest rate whose fitted response reaches
    ``target_pct`` while its own margin exceeds its bonus. A zone and hour has a row per tried rate.
    """
    curve = _tried(trials).groupBy("pu_location_id", "hour_of_day").agg(
        F.array_sort(F.collect_list(F.struct("rate_pct", "offers", "responses", "bonus", "margin"))).alias("at")
    )  # as many as there are rates

    def total(name: str, i: Column, k: Column) -> Column:
        return F.aggregate(F.slice("at", i + 1, k - i + 1), F.lit(0).cast("bigint"), lambda a, x: a + x[name])

    def pooled(i: Column, k: Column) -> Column:
        return total("responses", i, k).cast("double") / total("offers", i, k).cast("double")

    def fitted(at: Column) -> Column:
        last = F.size("at") - 1
        return F.array_max(F.transform(
            F.sequence(F.lit(0), at), lambda i: F.array_min(F.transform(F.sequence(at, last), lambda k: pooled(i, k)))
        ))

    fit = curve.withColumn("fit", F.transform("at", lambda _, i: fitted(i)))
    rows = fit.select("pu_location_id", "hour_of_day", F.posexplode("at").alias("i", "a"), "fit").select(
        "pu_location_id", "hour_of_day", "a.*", F.get("fit", c("i")).alias("fit")
    )
    fits = (c("fit") * 100 >= target_pct) & (c("margin") > c("bonus"))
    best = F.min(F.when(fits, c("rate_pct"))).over(Window.partitionBy("pu_location_id", "hour_of_day"))
    return rows.select(
        "pu_location_id", "hour_of_day", "rate_pct", "offers", "responses", F.round(c("fit") * 100, 4).alias("fitted_pct"),
        F.coalesce(c("rate_pct") == best, F.lit(False)).alias("chosen"),
    )


def zone_weeks(measures: DataFrame) -> DataFrame:
    """Trips with a wait and their mean wait per zone and week (weeks counted from a fixed Monday)."""
    waiting = measures.where("wait IS NOT NULL")
    return waiting.groupBy("pu_location_id", week_index(c("trip_date")).alias("week_index")).agg(
        F.count(F.lit(1)).alias("trips"), F.sum("wait").alias("sum_wait")
    ).withColumn("mean_wait", ratio("sum_wait", "trips", 4))


def lasting_waits(weeks: DataFrame, *, over_seconds: float, min_trips: int, min_weeks: int, spread: float = 3.0) -> DataFrame:
    """Zones whose waits stay long for weeks in a row, and the zone of their borough that moves most like them.

    ``weeks`` are :func:`zone_weeks` with ``borough``. A week counts if it has ``min_trips`` and is no outlier of its
    zone: further from the zone's median than ``spread`` times the median deviation, scaled to a standard
    deviation. Weeks in a row above ``over_seconds`` are an island; a week with too few trips, an outlier or a
    shorter wait ends it. Zones with an island of ``min_weeks`` are returned with the longest (the first of equals).
    ``like_zone_id`` has the least mean distance of weekly waits over at least ``min_weeks`` common weeks.
    """
    zone = Window.partitionBy("pu_location_id")  # as many rows as there are weeks
    enough = weeks.where(c("trips") >= min_trips)
    centred = enough.withColumn("median", F.median("mean_wait").over(zone)).withColumn("away", F.abs(c("mean_wait") - c("median")))
    usual = c("away") <= spread * 1.4826 * c("mad")
    known = centred.withColumn("mad", F.median("away").over(zone)).where(usual | (c("mad") == 0))
    long = known.where(c("mean_wait") > over_seconds)
    island = c("week_index") - F.row_number().over(zone.orderBy("week_index"))
    runs = long.withColumn("island", island).groupBy("pu_location_id", "island").agg(
        F.count(F.lit(1)).alias("weeks"), F.min("week_index").alias("first_week"), F.sum("trips").alias("trips"),
        F.sum("sum_wait").alias("sum_wait"),
    ).where(c("weeks") >= min_weeks)
    best = F.max_by(F.struct("weeks", "first_week", "trips", "sum_wait"), F.struct("weeks", -c("first_week")))
    lasting = runs.groupBy("pu_location_id").agg(best.alias("b")).select("pu_location_id", "b.*")
    # zones of a borough meet week by week; pairs are zones by zones, whatever the trips
    one = known.join(lasting.select("pu_location_id"), "pu_location_id", "left_semi").select(
        "pu_location_id", "borough", "week_index", "mean_wait"
    )
    other = known.select(
        c("pu_location_id").alias("like_zone_id"), "borough", "week_index", c("mean_wait").alias("like_wait")
    )
    near = one.join(other, ["borough", "week_index"]).where("pu_location_id <> like_zone_id").groupBy(
        "pu_location_id", "like_zone_id"
    ).agg(F.count(F.lit(1)).alias("common"), F.sum(F.abs(c("mean_wait") - c("like_wait")).cast("decimal(20,4)")).alias("d"))
    near = near.where(c("common") >= min_weeks).withColumn("distance", F.round(c("d").cast("double") / c("common"), 4))
    closest = near.groupBy("pu_location_id").agg(F.min(F.struct("distance", "like_zone_id")).alias("n"))
    return lasting.join(closest, "pu_location_id", "left").select(
        "pu_location_id", "weeks", "first_week", "trips", ratio("sum_wait", "trips", 1).alias("mean_wait"),
        c("n.like_zone_id").alias("like_zone_id"), c("n.distance").alias("like_distance"),
    )


def wait_and_speed(measures: DataFrame) -> DataFrame:
    """Waiting beside road speed by hour: long waits on free roads are not traffic."""
    rows = fold(measures, ["hour_of_day"], {"milli": "milli", "secs": "secs"}, "wait")
    return rounded_quantiles(
        rows, ["hour_of_day"],
        F.sum(ROWS).alias("trips"),
        _weighted("wait IS NOT NULL").alias("trips_with_wait"),
        _weighted(f"wait > {t.VERY_LONG_WAIT_SECONDS}").alias("late"),
        F.sum("milli").alias("milli"), F.sum("secs").alias("secs"),
        quantiles={"wait_p90": 0.9},
    ).select(
        "hour_of_day", c("hour_of_day").isin(*EVENING_HOURS).alias("evening"), "trips", "wait_p90",
        _pct("late", "trips_with_wait").alias("wait_gt15_pct"),
        ratio("milli", "secs", 2, times=18, unit=5).alias("avg_speed_mph"),
    )


def airport_share(measures: DataFrame) -> DataFrame:
    """Airport share of trips and revenue, counting trip ends and counting trips.

    A trip between two airports is two ends (the airport mart's view) but one
    trip (the segment view); both readings are given, with the days covered.
    """
    ends = (
        F.when(t.is_airport(c("pu_location_id")), 1).otherwise(0)
        + F.when(t.is_airport(c("do_location_id")), 1).otherwise(0)
    ).cast("bigint")
    daily = measures.withColumn("ends", ends).groupBy("trip_date").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("total").alias("total"),
        F.sum("ends").alias("ends"), F.sum(c("ends") * c("total")).alias("end_total"),
        _count("ends > 0").alias("airport_trips"),
        F.sum(F.expr("CASE WHEN ends > 0 THEN total ELSE 0L END")).alias("airport_total"),
        _count("do_location_id IN (1, 132, 138)").alias("dropoffs"),
    )
    return daily.agg(
        F.count(F.lit(1)).alias("days"),
        *[F.sum(x).alias(x) for x in daily.columns if x != "trip_date"],
    ).select(
        "days", "trips",
        _pct("ends", "trips").alias("ends_share_pct"),
        _pct("end_total", "total").alias("ends_revenue_pct"),
        _pct("airport_trips", "trips").alias("trips_share_pct"),
        _pct("airport_total", "total").alias("trips_revenue_pct"),
        ratio("dropoffs", "days", 2).alias("dropoffs_per_day"),
        ratio("total", "trips", 2, unit=CENTS).alias("avg_fare"),
    )


def airport_fares(measures: DataFrame) -> DataFrame:
    """Mean bill by airport over both directions."""
    return airport_ends(measures).groupBy("airport").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("total").alias("total")
    ).select("airport", "trips", ratio("total", "trips", 2, unit=CENTS).alias("avg_fare"),
             dollars("total").alias("sum_total_fare"))


def airport_trip_time(measures: DataFrame) -> DataFrame:
    """Travel time to each airport by pickup zone and hour, for departure advice."""
    to = measures.where(t.is_airport(c("do_location_id"))).withColumn(
        "airport", t.airport_name(c("do_location_id"))
    )
    keys = ["airport", "pu_location_id", "hour_of_day"]
    return rounded_quantiles(
        fold(to, keys, {}, "secs"), keys, F.sum(ROWS).alias("trips"), value="secs",
        quantiles={"trip_sec_p50": 0.5, "trip_sec_p90": 0.9},
    )


def neighbour_trips(measures: DataFrame, adjacency: DataFrame, treated: DataFrame) -> DataFrame:
    """Monthly trips of the zones beside treated zones (not themselves treated).

    ``adjacency``: (zone_id, neighbour_id); ``treated``: (zone_id). All three
    are at most zones x zones, trips are counted per zone before the join.
    """
    beside = (
        adjacency.join(treated, "zone_id", "left_semi")
        .join(treated.withColumnRenamed("zone_id", "neighbour_id"), "neighbour_id", "left_anti")
        .groupBy("neighbour_id").agg(F.count(F.lit(1)).alias("treated_neighbours"))
    )
    monthly = measures.groupBy("pu_location_id", "month").agg(F.count(F.lit(1)).alias("trips"))
    return monthly.join(beside, c("pu_location_id") == c("neighbour_id")).select(
        c("neighbour_id").alias("pu_location_id"), "month", "treated_neighbours", "trips"
    )
