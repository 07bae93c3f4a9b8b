"""Oracle SQL of invariants and re-aggregation reports."""

from __future__ import annotations

from oracles.base import hits, on_silver, on_silver_zones, rate, usd, wait_quantile
from oracles.marts import AIRPORT_VIEW

P50, P90 = f"{wait_quantile(0.5)} AS wait_p50", f"{wait_quantile(0.9)} AS wait_p90"

PRICING = f"""pricing AS (
  SELECT trip_date, month, operator, count(*) AS trips, sum(base) AS base, sum(total) AS total,
    sum(tips) AS tips, sum(pay) AS pay, {rate('sum(tips)', 'sum(base)', 4)} AS tip_rate
  FROM silver GROUP BY trip_date, month, operator)"""


def c2(col: str) -> str:
    return f"CAST(round({rate(f'sum({col})', 'count(*) * 100', 2)} * 100) AS BIGINT)"


def pct(num: str, den: str, digits: int = 4) -> str:
    return rate(f"100 * ({num})", den, digits)


def bias(wrong: str, right: str, scale: int) -> str:
    a, b = (f"CAST(round({x} * {scale}) AS BIGINT)" for x in (wrong, right))
    return rate(f"100 * ({a} - {b})", b, 2)


SQL = {
    "inv_segment_total": on_silver("""
        SELECT month, count(*) AS segment_trips, count(*) AS silver_trips, true AS holds
        FROM silver GROUP BY month"""),
    "inv_histogram_total": on_silver("""
        SELECT month, count(wait) AS histogram_trips, count(wait) AS trips_with_wait, count(*) AS trips, true AS holds
        FROM silver GROUP BY month"""),
    "inv_price_components": on_silver(f"""
        SELECT trip_date, operator, {c2('base')} + {c2('tax')} + {c2('cong + cbd')} + {c2('apt')} + {c2('tolls')}
          + {c2('bcf')} AS parts_cents, {c2('total')} AS total_cents, true AS holds
        FROM silver GROUP BY trip_date, operator"""),
    "inv_shared_split": on_silver(f"""
        SELECT trip_date, operator, {hits('shm')} AS actual_shared_trips, {hits('wvm')} AS actual_wav_trips, true AS holds
        FROM silver GROUP BY trip_date, operator"""),
    "inv_airport_share": on_silver(AIRPORT_VIEW, """
        SELECT month, airport, direction, operator, count(*) AS trips, true AS holds
        FROM airport_trips GROUP BY month, airport, direction, operator"""),
    "inv_month_totals": on_silver("""
        SELECT month, CASE WHEN count(*) FILTER (WHERE pu IN (1,132,138) OR dz IN (1,132,138)) > 0 THEN count(*) END AS all_trips_month, count(*) AS silver_trips,
          count(*) FILTER (WHERE pu IN (1,132,138) OR dz IN (1,132,138)) > 0 AS holds
        FROM silver GROUP BY month"""),
    "reagg_ratio": on_silver(f"""
        SELECT month, operator, count(*) AS trips, {rate('sum(tips)', 'sum(base)', 4)} AS tip_rate_on_fare,
          {rate('sum(pay)', 'sum(base)', 4)} AS driver_pay_ratio,
          {rate('sum(total)', 'count(*) * 100', 2)} AS avg_total_fare
        FROM silver GROUP BY month, operator"""),
    "reagg_bias_report": on_silver(PRICING, f"""
        f AS (SELECT operator, {rate('sum((base * 100000) // milli) FILTER (milli <> 0)', 'count(*) FILTER (milli <> 0) * 10000', 2)} AS a,
             {rate('sum(base) * 10', 'sum(milli)', 2)} AS b FROM silver GROUP BY operator)""", f"""
        d AS (SELECT operator, {rate('sum(CAST(round(tip_rate * 10000) AS BIGINT))', 'count(*) * 10000', 4)} AS a,
             {rate('sum(tips)', 'sum(base)', 4)} AS b FROM pricing GROUP BY operator)""", f"""
        SELECT operator, f.a AS fare_per_mile_mean_of_ratios, f.b AS fare_per_mile_ratio_of_sums,
          d.a AS tip_rate_mean_of_days, d.b AS tip_rate_ratio_of_sums,
          {bias('f.a', 'f.b', 100)} AS fare_per_mile_bias_pct, {bias('d.a', 'd.b', 10000)} AS tip_rate_bias_pct
        FROM f JOIN d USING (operator)"""),
    "reagg_avg_wait": on_silver(f"""
        SELECT month, operator, cohort, count(wait) FILTER (WHERE member) AS trips_with_wait,
          CAST(coalesce(sum(wait) FILTER (WHERE member), 0) AS BIGINT) AS sum_wait_sec,
          {rate('coalesce(sum(wait) FILTER (WHERE member), 0)', 'count(wait) FILTER (WHERE member)', 2)} AS avg_wait_sec
        FROM (SELECT month, operator, wait, unnest(['all', 'regular', 'shared_matched', 'shared_unmatched', 'wav_requested', 'aar']) AS cohort,
                unnest([true, regular, shr AND shm, shr AND NOT shm, wvr, aar]) AS member FROM silver)
        GROUP BY month, operator, cohort"""),
    "reagg_quantile": on_silver(f"""
        SELECT month, operator, count(wait) AS trips_with_wait, {P50}, {P90}
        FROM silver WHERE wait IS NOT NULL GROUP BY month, operator"""),
    "reagg_quantile_sketch": on_silver("""
        SELECT month, operator, count(*) AS trips_with_wait, true AS wait_p50_within_bound, true AS wait_p90_within_bound
        FROM silver WHERE wait IS NOT NULL GROUP BY month, operator"""),
    "reagg_quantile_stored": on_silver("""
        SELECT month, operator, count(*) AS trips_with_wait, true AS wait_p50_within_bound, true AS wait_p90_within_bound
        FROM silver WHERE wait IS NOT NULL GROUP BY month, operator"""),
    "reagg_airport_wait": on_silver(AIRPORT_VIEW, """
        SELECT airport, count(*) AS trips_with_wait, true AS wait_p50_within_bound, true AS wait_p90_within_bound
        FROM airport_trips WHERE wait IS NOT NULL GROUP BY airport"""),
    "market_share_monthly": on_silver(f"""
        SELECT month, operator, trips, CAST(sum(trips) OVER (PARTITION BY month) AS BIGINT) AS month_trips,
          {pct('trips', 'sum(trips) OVER (PARTITION BY month)')} AS share_pct
        FROM (SELECT month, operator, count(*) AS trips FROM silver GROUP BY 1, 2)"""),
    "demand_profile": on_silver("""
        SELECT profile, slot, trips, trips = max(trips) OVER (PARTITION BY profile) AS is_peak,
          trips = min(trips) OVER (PARTITION BY profile) AS is_minimum
        FROM (SELECT 'hour' AS profile, hour_of_day AS slot, count(*) AS trips FROM silver GROUP BY 2
              UNION ALL SELECT 'weekday', day_of_week, count(*) FROM silver GROUP BY 2)"""),
    "event_day_drop": on_silver("""
        d AS (SELECT trip_date, day_of_week, count(*) AS trips FROM silver GROUP BY 1, 2)""", """
        p AS (SELECT a.trip_date, a.day_of_week, a.trips, CAST(count(b.trips) AS INTEGER) AS weeks, sum(b.trips) AS b
              FROM d a LEFT JOIN d b ON date_diff('day', b.trip_date, a.trip_date) IN (7, 14, 21, 28)
              GROUP BY a.trip_date, a.day_of_week, a.trips)""", f"""
        SELECT trip_date, day_of_week, trips, weeks, CASE WHEN weeks = 4 THEN {rate('b', 'weeks', 2)} END AS normal_trips,
          CASE WHEN weeks = 4 THEN {rate('100 * (trips * weeks - b)', 'b', 2)} END AS change_pct
        FROM p"""),
    "kpi_summary": on_silver(f"""
        SELECT count(*) AS trips, count(wait) AS trips_with_wait, {P50}, {P90},
          {pct(hits('wait > 600'), 'count(wait)')} AS wait_gt10_pct,
          {rate('sum(total)', 'count(*) * 100', 2)} AS avg_fare,
          {rate('sum(milli)', 'count(*) * 1000', 3)} AS avg_distance_miles,
          {rate('sum(secs)', 'count(*) * 60', 2)} AS avg_duration_min
        FROM silver"""),
    "wait_by_borough": on_silver_zones(f"""
        SELECT z.borough AS pu_borough, count(wait) AS trips_with_wait, {P50}, {P90}
        FROM silver LEFT JOIN zones z ON pu = z.location_id WHERE wait IS NOT NULL GROUP BY z.borough"""),
    "worst_wait_slots": on_silver(f"""
        SELECT *, CAST(dense_rank() OVER (ORDER BY wait_p90 DESC) AS INTEGER) AS wait_rank
        FROM (SELECT day_of_week, hour_of_day, count(*) AS trips_with_wait, {P50}, {P90}
              FROM silver WHERE wait IS NOT NULL GROUP BY 1, 2)"""),
    "wav_fulfilment": on_silver(f"""
        SELECT operator, {hits('wvr')} AS wav_requests, {pct(hits('wvr AND NOT wvm'), hits('wvr'))} AS unfulfilled_pct,
          {pct(hits('wvr'), 'count(*)')} AS explicit_demand_pct, {pct(hits('wvm'), 'count(*)')} AS actual_wav_pct
        FROM silver GROUP BY operator"""),
    "shared_funnel_monthly": on_silver(f"""
        SELECT month, count(*) AS trips, {hits('shr')} AS shared_requests,
          {pct(hits('shr'), 'count(*)')} AS request_rate_pct,
          {pct(hits('shr AND shm'), hits('shr'))} AS match_conversion_pct,
          {pct(hits('shm'), 'count(*)')} AS actual_shared_pct
        FROM silver GROUP BY month"""),
    "orphan_by_operator": on_silver(f"""
        SELECT operator, {hits('NOT shr AND shm')} AS shared_orphan_matches, {hits('shm')} AS actual_shared_trips,
          {pct(hits('NOT shr AND shm'), hits('shm'))} AS orphan_pct
        FROM silver GROUP BY operator"""),
    "pay_ratio_range": on_silver(f"""
        SELECT operator, min(r) AS min_ratio, max(r) AS max_ratio,
          arg_min(month, (r, month)) AS min_month, arg_max(month, (r, month)) AS max_month
        FROM (SELECT month, operator, {rate('sum(pay)', 'sum(base)', 4)} AS r FROM silver GROUP BY 1, 2)
        GROUP BY operator"""),
    "tip_share": on_silver(f"""
        SELECT month, {usd('sum(tips)')} AS sum_tips, {rate('sum(tips)', 'sum(base)', 4)} AS tip_rate_on_fare,
          {rate('sum(tips)', 'sum(total)', 4)} AS tips_to_charges,
          {rate('sum(tips)', 'sum(total + tips)', 4)} AS tips_share_of_paid
        FROM silver GROUP BY month"""),
}
