"""The gold tables.

Each mart is data: keys, additive sums over silver rows, optional quantiles,
and a ``finish`` step that turns sums into the published columns. Marts with
the same keys can share one aggregate (see :func:`shared_bases`). Zone names
are joined after aggregation wherever the grain allows it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbflow.functions import trip as t
from curbflow.functions.fixed import CENTS, MILLI, dollars, miles, ratio
from curbflow.functions.grouping import ROWS, fold, rows_where, tally, unfold

c = F.col
WAIT_QUANTILES = {"wait_p50": 0.5, "wait_p90": 0.9}


# ── additive sums over silver rows, as SQL over the columns of trip.measures ──

Sums = dict[str, str]


def _wait_over(seconds: int, cond: str = "true") -> str:
    return tally(f"wait > {seconds} AND {cond}")


SCHEDULED: Sums = {"scheduled_rides": tally("wait_sec < 0")}
# these follow from the folded wait and its count
WITH_WAIT: Sums = {"trips_with_wait": rows_where("wait IS NOT NULL")}
LATE: Sums = {
    "trips_wait_gt10": rows_where(f"wait > {t.LONG_WAIT_SECONDS}"),
    "trips_wait_gt15": rows_where(f"wait > {t.VERY_LONG_WAIT_SECONDS}"),
}
DISTANCE: Sums = {"s_milli": "milli"}
TIME: Sums = {"sum_time_sec": "secs"}
TOTAL: Sums = {"s_total": "total"}
MONEY: Sums = {"s_base": "base", "s_total": "total", "s_tips": "tips", "s_pay": "pay"}
CHARGE_PARTS: Sums = {
    "s_tax": "tax", "s_congestion": "congestion", "s_cbd": "cbd",
    "s_airport": "airport_fee", "s_tolls": "tolls", "s_bcf": "bcf",
}
FEATURES: Sums = {
    name: tally(cond) for name, cond in {
        "shared_requests": "shared_request",
        "shared_requested_matches": "shared_request AND shared_match",
        "shared_orphan_matches": "NOT shared_request AND shared_match",
        "actual_shared_trips": "shared_match",
        "wav_requests": "wav_request",
        "wav_requested_matches": "wav_request AND wav_match",
        "wav_unrequested_matches": "NOT wav_request AND wav_match",
        "actual_wav_trips": "wav_match",
        "access_a_ride_trips": "aar",
        "access_a_ride_wav_requests": "aar AND wav_request",
        "access_a_ride_wav_requested_matches": "aar AND wav_request AND wav_match",
        "access_a_ride_wav_matches": "aar AND wav_match",
    }.items()
}
COHORTS = {
    "all": "true",
    "regular": "regular",
    "shared_matched": "shared_request AND shared_match",
    "shared_unmatched": "shared_request AND NOT shared_match",
    "wav_requested": "wav_request",
    "aar": "aar",
}


def cohort_waits(prefix: str, cond: str, late: bool) -> Sums:
    """Count and sum of the valid waits of a cohort, and its long waits if asked."""
    out = {
        f"{prefix}trips_with_wait": tally(f"wait IS NOT NULL AND {cond}"),
        f"{prefix}sum_wait_sec": f"CASE WHEN wait IS NOT NULL AND {cond} THEN wait ELSE 0L END",
    }
    if late:
        out[f"{prefix}wait_gt10"] = _wait_over(t.LONG_WAIT_SECONDS, cond)
        out[f"{prefix}wait_gt15"] = _wait_over(t.VERY_LONG_WAIT_SECONDS, cond)
    return out


COHORT_WAITS: Sums = {
    k: v for name, cond in COHORTS.items()
    for k, v in cohort_waits(f"{name}_", cond, late=True).items()
}
FEATURE_WAITS: Sums = {
    **cohort_waits("", "true", late=False),
    **cohort_waits("shared_", "shared_request", late=False),
    **cohort_waits("wav_", "wav_request", late=False),
    **cohort_waits("regular_", "regular", late=False),
}


# ── published columns from sums ──────────────────────────────────────────────

def _waits() -> list[Column]:
    return [F.round("wait_p50", 1).alias("wait_p50"), F.round("wait_p90", 1).alias("wait_p90")]


def _mean_money(name: str, total: str) -> Column:
    return ratio(total, "trips", 2, unit=CENTS).alias(name)


def _mean_miles() -> Column:
    return ratio("s_milli", "trips", 3, unit=MILLI).alias("avg_distance_miles")


def _mean_minutes() -> Column:
    return ratio("sum_time_sec", "trips", 2, unit=60).alias("avg_duration_min")


def _mph() -> Column:
    # thousandths of a mile * 3600 / (seconds * 1000)
    return ratio("s_milli", "sum_time_sec", 2, times=18, unit=5).alias("avg_speed_mph")


def _per_mile() -> Column:
    # cents / 100 over thousandths / 1000
    return ratio("s_base", "s_milli", 2, times=10).alias("fare_per_mile")


def _sum_miles() -> Column:
    return miles("s_milli").alias("sum_miles")


def _share(name: str, num: str, den: str, digits: int = 4) -> Column:
    return ratio(num, den, digits).alias(name)


def _money_sums(*names: str) -> list[Column]:
    source = {
        "sum_base_fare": "s_base", "sum_total_fare": "s_total",
        "sum_tips": "s_tips", "sum_driver_pay": "s_pay",
    }
    return [dollars(source[n]).alias(n) for n in names]


def _segment_money() -> list[Column]:
    return [
        _mean_money("avg_fare", "s_total"),
        _mean_money("avg_driver_pay", "s_pay"),
        _per_mile(),
        _share("tip_rate_on_fare", "s_tips", "s_base"),
        _share("driver_pay_ratio", "s_pay", "s_base"),
        *_money_sums("sum_base_fare", "sum_total_fare", "sum_tips", "sum_driver_pay"),
        _sum_miles(),
    ]


def named_zones(df: DataFrame, zones: DataFrame, zone_id: str, prefix: str) -> DataFrame:
    """Left join of zone name and borough; a few hundred rows, so Spark sizes it itself."""
    dim = zones.select(
        c("location_id").alias("_zone_id"),
        c("zone").alias(f"{prefix}_zone_name"),
        c("borough").alias(f"{prefix}_borough"),
    )
    return df.join(dim, c(zone_id) == c("_zone_id"), "left").drop("_zone_id")


# ── mart definitions ─────────────────────────────────────────────────────────

Finish = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class Mart:
    keys: list[str]
    sums: Mapping[str, str]
    finish: Finish
    spread: str | None = None
    quantiles: Mapping[str, float] = field(default_factory=dict)
    # sums over folded rows, from the spread value and the row count
    of_spread: Mapping[str, str] = field(default_factory=dict)
    prepare: Finish | None = None
    # keys of the fold and how its rows turn into rows with ``keys``, if they differ
    fold_keys: list[str] | None = None
    split: Callable[[DataFrame], DataFrame] | None = None


def aggregate(
    rows: DataFrame,
    keys: list[str],
    sums: Mapping[str, str],
    spread: str | None = None,
    quantiles: Mapping[str, float] | None = None,
    of_spread: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows per group as ``trips``, the sums, and quantiles of ``spread`` if asked."""
    if spread:
        folded = fold(rows, keys, sums, spread)
        return unfold(folded, keys, list(sums), spread, quantiles or {}, of_spread)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trips"), *[F.sum(F.expr(v)).alias(k) for k, v in sums.items()]
    )


def _overview(b: DataFrame, _: DataFrame) -> DataFrame:
    return b.select(
        "trip_date", "operator", "trips", "scheduled_rides", "trips_with_wait", *_waits(),
        _mean_miles(), _mean_minutes(), _mph(), _mean_money("avg_fare", "s_total"),
        _sum_miles(), "sum_time_sec", *_money_sums("sum_total_fare"),
    )


def _hourly(b: DataFrame, _: DataFrame) -> DataFrame:
    return b.select(
        "month", "hour_of_day", "day_of_week", "operator",
        "trips", "scheduled_rides", "trips_with_wait", *_waits(),
        "trips_wait_gt10", "trips_wait_gt15",
        _share("share_wait_gt10", "trips_wait_gt10", "trips_with_wait"),
        _share("share_wait_gt15", "trips_wait_gt15", "trips_with_wait"),
        _mean_minutes(), _mph(), _mean_money("avg_fare", "s_total"),
        "shared_requests", c("shared_requested_matches").alias("shared_matches"),
        "wav_requests", c("wav_requested_matches").alias("wav_matches"),
        _sum_miles(), "sum_time_sec", *_money_sums("sum_total_fare"),
    )


def _pickup_zones(b: DataFrame, zones: DataFrame) -> DataFrame:
    return named_zones(b, zones, "pu_location_id", "pu").select(
        "trip_date", "pu_location_id", "pu_zone_name", "pu_borough", "operator",
        "trips", "scheduled_rides", "trips_with_wait", *_waits(),
        _mean_money("avg_fare", "s_total"), _mean_miles(),
        _sum_miles(), *_money_sums("sum_total_fare"),
    )


def _routes(b: DataFrame, zones: DataFrame) -> DataFrame:
    # some names belong to several ids, so the counts are added up again by name
    named = named_zones(named_zones(b, zones, "pu_location_id", "pu"), zones, "do_location_id", "do")
    return named.groupBy("month", "pu_zone_name", "do_zone_name").agg(F.sum("trips").alias("trips"))


def _pricing(b: DataFrame, _: DataFrame) -> DataFrame:
    return b.select(
        "trip_date", "operator", "trips",
        _mean_money("avg_base_fare", "s_base"),
        _mean_money("avg_tax", "s_tax"),
        _mean_money("avg_congestion", "s_congestion + s_cbd"),
        _mean_money("avg_airport_fee", "s_airport"),
        _mean_money("avg_toll", "s_tolls"),
        _mean_money("avg_bcf", "s_bcf"),
        _mean_money("avg_tip", "s_tips"),
        _mean_money("avg_driver_pay", "s_pay"),
        _mean_money("avg_total_fare", "s_total"),
        _mean_money("avg_platform_gross_take", "s_base - s_pay"),
        _mean_money("avg_regulatory_load", "s_bcf + s_tax + s_congestion + s_cbd"),
        _mean_money("avg_pass_through", "s_tolls + s_airport"),
        _per_mile(),
        _share("tip_rate_on_fare", "s_tips", "s_base"),
        _share("tips_to_charges", "s_tips", "s_total"),
        _share("tips_share_of_paid", "s_tips", "s_total + s_tips"),
        _share("driver_pay_ratio", "s_pay", "s_base"),
        *_money_sums("sum_base_fare", "sum_total_fare", "sum_tips", "sum_driver_pay"),
        _sum_miles(),
    )


def with_segment(m: DataFrame, zones: DataFrame) -> DataFrame:
    """Adds ``segment``; joined before aggregation because it is so coarse a key."""
    named = named_zones(named_zones(m, zones, "pu_location_id", "pu"), zones, "do_location_id", "do")
    return named.withColumn(
        "segment",
        t.segment(c("pu_location_id"), c("do_location_id"), c("pu_borough"), c("do_borough")),
    )


def _economics(b: DataFrame, _: DataFrame) -> DataFrame:
    return b.select("month", "segment", "operator", "trips", *_segment_money())


def _shared_wav_daily(b: DataFrame, _: DataFrame) -> DataFrame:
    return b.select(
        "trip_date", "operator", "trips", *FEATURES, *COHORT_WAITS,
        _share("shared_request_rate", "shared_requests", "trips"),
        _share("shared_match_rate", "shared_requested_matches", "shared_requests"),
        _share("actual_shared_rate", "actual_shared_trips", "trips"),
        _share("wav_request_rate", "wav_requests", "trips"),
        _share("wav_fulfillment_rate", "wav_requested_matches", "wav_requests"),
        _share("actual_wav_rate", "actual_wav_trips", "trips"),
        _share("access_a_ride_rate", "access_a_ride_trips", "trips"),
    )


def _features_by_zone(b: DataFrame, zones: DataFrame) -> DataFrame:
    return named_zones(b, zones, "pu_location_id", "pu").select(
        "trip_date", "pu_location_id", "pu_zone_name", "pu_borough", "operator",
        "trips", *FEATURE_WAITS, *FEATURES, _sum_miles(),
    )


def _shared_wav_hourly(b: DataFrame, _: DataFrame) -> DataFrame:
    return b.select(
        "trip_date", "hour_of_day", "day_of_week", "operator", "trips", *FEATURE_WAITS, *FEATURES
    )


def _bucketed(bucket: Callable[[Column], Column]) -> Finish:
    return lambda m, _: m.where(c("wait").isNotNull()).withColumn("bucket_order", bucket(c("wait")))


def _histogram(label: Callable[[Column], Column]) -> Finish:
    return lambda b, _: b.select(
        "month", "operator", "bucket_order", label(c("bucket_order")).alias("wait_bucket"),
        c("trips").alias("trips_with_wait"),
    )


def _cents_quantile(name: str) -> Column:
    # interpolated cents, cleared of float noise, to whole cents half to even
    return (F.bround(F.round(name, 6), 0) / 100.0).alias(name)


def _fare_distance(b: DataFrame, _: DataFrame) -> DataFrame:
    return b.select(
        "month", "operator", c("mile_bin").alias("distance_bin_miles"), "trips", _mean_miles(),
        _mean_money("avg_base_fare", "s_base"), _mean_money("avg_total_fare", "s_total"),
        _cents_quantile("fare_p50"), _cents_quantile("fare_p90"), _mean_minutes(),
        *_money_sums("sum_base_fare"), _sum_miles(),
    )


PU_AIRPORT, DO_AIRPORT = "pu_airport", "do_airport"


def _with_airports(m: DataFrame) -> DataFrame:
    return m.withColumns({
        PU_AIRPORT: t.airport_name(c("pu_location_id")),
        DO_AIRPORT: t.airport_name(c("do_location_id")),
    })


def _split_ends(df: DataFrame, extra: list[Column]) -> DataFrame:
    """A row per airport end, plus the given (airport, direction) structs."""
    def end(name: str, direction: str) -> Column:
        return F.when(c(name).isNotNull(), F.struct(
            c(name).alias("airport"), F.lit(direction).alias("direction")))

    ends = F.array(end(PU_AIRPORT, "pickup"), end(DO_AIRPORT, "dropoff"), *extra)
    rest = [x for x in df.columns if x not in (PU_AIRPORT, DO_AIRPORT)]
    return df.select(*rest, F.explode(F.array_compact(ends)).alias("end")).select(
        *rest, "end.airport", "end.direction"
    )


def airport_ends(m: DataFrame) -> DataFrame:
    """One row per airport end of a trip; airport-to-airport trips give two."""
    return _split_ends(_with_airports(m), [])


def _airport_rows(m: DataFrame, _: DataFrame) -> DataFrame:
    # trips elsewhere only count towards totals: without a wait they fold to one row
    named = _with_airports(m)
    touches = c(PU_AIRPORT).isNotNull() | c(DO_AIRPORT).isNotNull()
    return named.withColumn("wait", F.when(touches, c("wait")))


def _airport_directions(folded: DataFrame) -> DataFrame:
    """Split the folded rows into directions; 'all' carries the totals of a month.

    This happens after the map-side fold, so no trip row is ever multiplied.
    """
    everything = F.struct(F.lit("").alias("airport"), F.lit("all").alias("direction"))
    return _split_ends(folded, [everything])


def _airports(b: DataFrame, _: DataFrame) -> DataFrame:
    total = F.sum(F.when(c("direction") == "all", c("trips")))
    by_month = Window.partitionBy("month")
    with_totals = b.select(
        "*",
        total.over(by_month).alias("all_trips_month"),
        total.over(Window.partitionBy("month", "operator")).alias("all_trips_month_operator"),
    ).where(c("direction") != "all")
    return with_totals.select(
        "month", "airport", "direction", "operator", "trips",
        "all_trips_month", "all_trips_month_operator",
        ratio("trips", "all_trips_month", 4, times=100).alias("airport_share_all_trips_pct"),
        ratio("trips", "all_trips_month_operator", 4, times=100)
        .alias("airport_share_operator_trips_pct"),
        _mean_money("avg_fare", "s_total"), _mean_miles(), _mean_minutes(),
        "trips_with_wait", *_waits(), *_money_sums("sum_total_fare"), _sum_miles(),
    )


MARTS: dict[str, Mart] = {
    "mart_overview_daily": Mart(
        ["trip_date", "operator"],
        SCHEDULED | DISTANCE | TIME | TOTAL,
        _overview, "wait", WAIT_QUANTILES, WITH_WAIT,
    ),
    "mart_hourly_pattern": Mart(
        ["month", "hour_of_day", "day_of_week", "operator"],
        SCHEDULED | DISTANCE | TIME | TOTAL
        | {k: FEATURES[k] for k in (
            "shared_requests", "shared_requested_matches", "wav_requests", "wav_requested_matches",
        )},
        _hourly, "wait", WAIT_QUANTILES, WITH_WAIT | LATE,
    ),
    "mart_pickup_zones": Mart(
        ["trip_date", "pu_location_id", "operator"],
        SCHEDULED | DISTANCE | TOTAL,
        _pickup_zones, "wait", WAIT_QUANTILES, WITH_WAIT,
    ),
    "mart_routes": Mart(["month", "pu_location_id", "do_location_id"], {}, _routes),
    "mart_pricing": Mart(
        ["trip_date", "operator"], MONEY | CHARGE_PARTS | DISTANCE, _pricing
    ),
    "mart_economics_segment": Mart(
        ["month", "segment", "operator"], MONEY | DISTANCE, _economics, prepare=with_segment
    ),
    "mart_shared_wav_daily": Mart(
        ["trip_date", "operator"], FEATURES | COHORT_WAITS, _shared_wav_daily
    ),
    "mart_features_by_zone": Mart(
        ["trip_date", "pu_location_id", "operator"],
        FEATURES | FEATURE_WAITS | DISTANCE, _features_by_zone,
    ),
    "mart_shared_wav_hourly": Mart(
        ["trip_date", "hour_of_day", "day_of_week", "operator"],
        FEATURES | FEATURE_WAITS, _shared_wav_hourly,
    ),
    "mart_wait_histogram": Mart(
        ["month", "operator", "bucket_order"], {},
        _histogram(t.wait_bucket_label), prepare=_bucketed(t.wait_bucket),
    ),
    "mart_wait_histogram_minute": Mart(
        ["month", "operator", "bucket_order"], {},
        _histogram(t.wait_minute_label), prepare=_bucketed(t.wait_minute_bucket),
    ),
    "mart_fare_distance": Mart(
        ["month", "operator", "mile_bin"],
        TOTAL | DISTANCE | TIME, _fare_distance, "base", {"fare_p50": 0.5, "fare_p90": 0.9},
        {"s_base": f"base * {ROWS}"},
    ),
    "mart_airports": Mart(
        ["month", "airport", "direction", "operator"],
        DISTANCE | TIME | TOTAL, _airports, "wait", WAIT_QUANTILES, WITH_WAIT,
        prepare=_airport_rows, fold_keys=["month", "operator", PU_AIRPORT, DO_AIRPORT],
        split=_airport_directions,
    ),
}


def build(name: str, trips: DataFrame, zones: DataFrame) -> DataFrame:
    """One mart from bronze trips and the zone dimension."""
    mart = MARTS[name]
    rows = t.measures(trips)
    if mart.prepare:
        rows = mart.prepare(rows, zones)
    if mart.split:
        folded = mart.split(fold(rows, mart.fold_keys, mart.sums, mart.spread))
        base = unfold(
            folded, mart.keys, list(mart.sums), mart.spread, mart.quantiles, mart.of_spread
        )
    else:
        base = aggregate(
            rows, mart.keys, mart.sums, mart.spread, mart.quantiles, mart.of_spread
        )
    return mart.finish(base, zones)


def shared_bases(trips: DataFrame) -> dict[str, tuple[DataFrame, list[str]]]:
    """Aggregates that serve several marts of one grain, with the mart names.

    A full gold build computes each of them once instead of scanning bronze
    once per mart.
    """
    grains: dict[tuple[str, ...], list[str]] = {}
    for name, mart in MARTS.items():
        if mart.prepare is None:
            grains.setdefault(tuple(mart.keys), []).append(name)
    rows = t.measures(trips)
    bases = {}
    for keys, names in grains.items():
        if len(names) < 2:
            continue
        sums: Sums = {}
        for n in names:
            sums.update(MARTS[n].sums)
        folded = next((MARTS[n] for n in names if MARTS[n].spread), None)
        if folded:
            rest = {k: v for k, v in sums.items() if k not in folded.of_spread}
            base = aggregate(
                rows, list(keys), rest, folded.spread, folded.quantiles, folded.of_spread
            )
        else:
            base = aggregate(rows, list(keys), sums)
        bases["+".join(keys)] = (base, names)
    return bases
