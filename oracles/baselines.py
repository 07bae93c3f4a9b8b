"""Oracle SQL of the hypothesis baselines."""

from __future__ import annotations

from oracles.base import (
    cents_quantile, hits, on_silver, on_silver_zones, rate, usd, wait_quantile,
)
from oracles.marts import AIRPORT_VIEW, MPH
from oracles.reports import pct

P50, P90 = f"{wait_quantile(0.5)} AS wait_p50", f"{wait_quantile(0.9)} AS wait_p90"
GT15 = f"{pct(hits('wait > 900'), 'count(wait)')} AS wait_gt15_pct"
AP = "(1, 132, 138)"

DEFICIT = f"""
        cells AS (SELECT pu, hour_of_day, month, count(*) AS n, {P90} FROM silver WHERE wait IS NOT NULL GROUP BY 1, 2, 3),
        hours AS (SELECT pu, hour_of_day, sum(n) AS n FROM cells WHERE n >= 1 AND wait_p90 > 900
                  GROUP BY 1, 2 HAVING count(*) >= 2),
        scored AS (SELECT pu, count(*) AS deficit_hours, CAST(sum(n) AS BIGINT) AS trips FROM hours GROUP BY pu),
        ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY deficit_hours DESC, trips DESC, pu) AS INTEGER) AS zone_rank FROM scored)"""

SQL = {
    "tips_baseline": on_silver(f"""
        SELECT count(*) AS trips, {rate('sum(tips)', 'count(*) * 100', 4)} AS avg_tip,
          {pct(hits('tips > 0'), 'count(*)')} AS tipped_pct,
          {cents_quantile(0.5, 'CASE WHEN tips > 0 THEN tips END')} AS median_tip_of_givers,
          {pct(hits('tips > 0 AND tips < 500'), hits('tips > 0'))} AS under_5_pct,
          {pct(hits('tips >= 500'), hits('tips > 0'))} AS from_5_pct
        FROM silver"""),
    "roundup_simulation": on_silver("gaps AS (SELECT *, (50 - total % 50) % 50 AS gap FROM silver)", f"""
        SELECT conversion_pct, count(*) AS trips, {hits('tips < 500')} AS eligible,
          {pct(hits('tips < 500 AND gap = 0'), hits('tips < 500'))} AS round_already_pct,
          {pct(hits('tips < 500 AND gap BETWEEN 1 AND 9'), hits('tips < 500'))} AS too_small_pct,
          {pct(hits('tips < 500 AND gap >= 10'), hits('tips < 500'))} AS shown_pct,
          {rate('sum(gap) FILTER (WHERE tips < 500 AND gap >= 10)', hits('tips < 500 AND gap >= 10') + ' * 100', 4)} AS avg_extra,
          {rate('conversion_pct * sum(gap) FILTER (WHERE tips < 500 AND gap >= 10)', 'sum(tips)', 4)} AS tips_uplift_pct
        FROM gaps CROSS JOIN (SELECT unnest([15::BIGINT, 30, 100]) AS conversion_pct) GROUP BY conversion_pct"""),
    "tips_by_month": on_silver("""
        m AS (SELECT month, count(*) AS n, sum(tips) AS s, count(*) FILTER (WHERE tips > 0) AS k FROM silver GROUP BY month),
        b AS (SELECT sum(n) AS bn, sum(s) AS bs FROM m WHERE month(month) <> 12)""", f"""
        SELECT month, n AS trips, {rate('s', 'n * 100', 4)} AS avg_tip, {pct('k', 'n')} AS tipped_pct,
          {rate('100 * (s * bn - bs * n)', 'bs * n', 2)} AS lift_pct
        FROM m CROSS JOIN b"""),
    "wait_by_hour": on_silver(f"""
        SELECT hour_of_day, count(*) AS trips_with_wait, {P50}, {P90}, {GT15}
        FROM silver WHERE wait IS NOT NULL GROUP BY hour_of_day"""),
    "busy_hour_pay": on_silver(f"""
        SELECT hour_of_day, count(*) AS trips, {rate('36 * sum(pay)', 'sum(secs)', 2)} AS pay_per_busy_hour
        FROM silver GROUP BY hour_of_day"""),
    "pay_floor_gap": on_silver(
        "g AS (SELECT month, operator, pay * 10000 - 11350 * secs - 1283 * milli AS gap FROM silver WHERE trip_date >= DATE '2026-03-01')",
        f"""
        SELECT month, operator, count(*) AS trips, {pct(hits('gap < 0'), 'count(*)')} AS below_floor_pct,
          {rate('sum(gap)', 'count(*) * 1000000', 2)} AS avg_gap
        FROM g GROUP BY month, operator"""),
    "scheduled_share": on_silver(f"""
        SELECT hour_of_day, CASE WHEN dz IN {AP} THEN 'to airport' WHEN pu IN {AP} THEN 'from airport' ELSE 'city' END AS direction,
          count(*) AS trips, {hits('wait_sec < 0')} AS scheduled_rides, {pct(hits('wait_sec < 0'), 'count(*)')} AS scheduled_pct
        FROM silver GROUP BY 1, 2"""),
    "zone_hour_wait": on_silver(f"""
        SELECT pu AS pu_location_id, hour_of_day, count(*) AS trips_with_wait, {P50}, {P90}, {GT15}
        FROM silver WHERE wait IS NOT NULL GROUP BY pu, hour_of_day"""),
    "deficit_window_select": on_silver_zones(DEFICIT, """
        SELECT pu AS pu_location_id, deficit_hours, trips, zone_rank, z.zone AS zone_name, z.borough
        FROM ranked LEFT JOIN zones z ON pu = location_id WHERE zone_rank <= 8"""),
    "bonus_rate_choice": on_silver("""
        offers AS (SELECT *, [2::BIGINT, 5, 8, 11, 14][(secs + pu) % 5 + 1] AS rate_pct FROM silver),
        trials AS (SELECT *, coalesce(wait, 0) < 400 + 40 * rate_pct AS responded FROM offers),
        tried AS (SELECT pu, hour_of_day, rate_pct, count(*) AS offers, count(*) FILTER (WHERE responded) AS responses,
            coalesce(sum(pay * rate_pct) FILTER (WHERE responded), 0) AS bonus,
            coalesce(sum(100 * (base - pay)) FILTER (WHERE responded), 0) AS margin
          FROM trials GROUP BY 1, 2, 3)""", f"""
        SELECT pu AS pu_location_id, hour_of_day, rate_pct, offers, responses,
          {rate('bonus', '10000', 2)} AS bonus_paid, {rate('margin', '10000', 2)} AS margin_earned
        FROM tried WHERE responses * 100 >= offers * 60 AND margin > bonus
        QUALIFY row_number() OVER (PARTITION BY pu, hour_of_day ORDER BY rate_pct) = 1"""),
    "bonus_response_curve": on_silver("""
        offers AS (SELECT *, [2::BIGINT, 5, 8, 11, 14][(secs + pu) % 5 + 1] AS rate_pct FROM silver),
        trials AS (SELECT *, coalesce(wait, 0) < 400 + 40 * rate_pct AS responded FROM offers),
        tried AS (SELECT pu, hour_of_day, rate_pct, count(*) AS offers, count(*) FILTER (WHERE responded) AS responses,
            coalesce(sum(pay * rate_pct) FILTER (WHERE responded), 0) AS bonus,
            coalesce(sum(100 * (base - pay)) FILTER (WHERE responded), 0) AS margin
          FROM trials GROUP BY 1, 2, 3),
        pooled AS (SELECT i.pu, i.hour_of_day, i.rate_pct AS lo, k.rate_pct AS hi,
            sum(x.responses)::DOUBLE / sum(x.offers)::DOUBLE AS share
          FROM tried i JOIN tried k ON i.pu = k.pu AND i.hour_of_day = k.hour_of_day AND i.rate_pct <= k.rate_pct
          JOIN tried x ON x.pu = i.pu AND x.hour_of_day = i.hour_of_day AND x.rate_pct BETWEEN i.rate_pct AND k.rate_pct
          GROUP BY ALL),
        fits AS (SELECT pu, hour_of_day, rate_pct, max(low) AS fit FROM (
            SELECT t.pu, t.hour_of_day, t.rate_pct, p.lo, min(p.share) AS low
            FROM tried t JOIN pooled p ON p.pu = t.pu AND p.hour_of_day = t.hour_of_day AND p.lo <= t.rate_pct AND p.hi >= t.rate_pct
            GROUP BY ALL) GROUP BY ALL)""", """
        SELECT pu AS pu_location_id, hour_of_day, rate_pct, offers, responses, round(fit * 100, 4) AS fitted_pct,
          coalesce(rate_pct = min(rate_pct) FILTER (fit * 100 >= 60 AND margin > bonus) OVER (PARTITION BY pu, hour_of_day), false) AS chosen
        FROM tried JOIN fits USING (pu, hour_of_day, rate_pct)"""),
    "lasting_wait_zones": on_silver_zones(f"""
        weeks AS (SELECT pu, CAST(date_diff('day', DATE '2024-12-30', trip_date) // 7 AS INTEGER) AS week, count(*) AS trips,
            CAST(sum(wait) AS BIGINT) AS sum_wait, {rate('sum(wait)', 'count(*)', 4)} AS mean_wait
          FROM silver WHERE wait IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2),
        medians AS (SELECT *, median(mean_wait) OVER (PARTITION BY pu) AS mid FROM weeks),
        spreads AS (SELECT *, median(abs(mean_wait - mid)) OVER (PARTITION BY pu) AS mad FROM medians),
        known AS (SELECT s.*, z.borough FROM spreads s JOIN zones z ON pu = location_id
          WHERE abs(mean_wait - mid) <= 3.0::DOUBLE * 1.4826::DOUBLE * mad OR mad = 0),
        runs AS (SELECT pu, count(*) AS weeks, min(week) AS first_week, sum(trips) AS trips, sum(sum_wait) AS sum_wait
          FROM (SELECT *, week - row_number() OVER (PARTITION BY pu ORDER BY week) AS island FROM known WHERE mean_wait > 720)
          GROUP BY pu, island HAVING count(*) >= 3),
        best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY pu ORDER BY weeks DESC, first_week) = 1),
        near AS (SELECT a.pu, b.pu AS other, round(sum(CAST(abs(a.mean_wait - b.mean_wait) AS DECIMAL(20,4)))::DOUBLE / count(*), 4) AS distance
          FROM known a JOIN known b ON a.borough = b.borough AND a.week = b.week AND a.pu <> b.pu
          WHERE a.pu IN (SELECT pu FROM best) GROUP BY 1, 2 HAVING count(*) >= 3
          QUALIFY row_number() OVER (PARTITION BY a.pu ORDER BY distance, other) = 1)""", f"""
        SELECT pu AS pu_location_id, weeks, CAST(first_week AS INTEGER) AS first_week, CAST(trips AS BIGINT) AS trips,
          {rate('sum_wait', 'trips', 1)} AS mean_wait, other AS like_zone_id, distance AS like_distance
        FROM best LEFT JOIN near USING (pu)"""),
    "evening_wait_speed": on_silver(f"""
        SELECT hour_of_day, hour_of_day IN (22, 23) AS evening, count(*) AS trips, {P90}, {GT15}, {MPH}
        FROM silver GROUP BY hour_of_day"""),
    "airport_share": on_silver(
        f"e AS (SELECT *, CAST(pu IN {AP} AS INTEGER) + CAST(dz IN {AP} AS INTEGER) AS ends FROM silver)", f"""
        SELECT count(DISTINCT trip_date) AS days, count(*) AS trips, {pct('sum(ends)', 'count(*)')} AS ends_share_pct,
          {pct('sum(ends * total)', 'sum(total)')} AS ends_revenue_pct, {pct(hits('ends > 0'), 'count(*)')} AS trips_share_pct,
          {pct('coalesce(sum(total) FILTER (WHERE ends > 0), 0)', 'sum(total)')} AS trips_revenue_pct,
          {rate(hits(f'dz IN {AP}'), 'count(DISTINCT trip_date)', 2)} AS dropoffs_per_day,
          {rate('sum(total)', 'count(*) * 100', 2)} AS avg_fare
        FROM e"""),
    "airport_fares": on_silver(AIRPORT_VIEW, f"""
        SELECT airport, count(*) AS trips, {rate('sum(total)', 'count(*) * 100', 2)} AS avg_fare,
          {usd('sum(total)')} AS sum_total_fare
        FROM airport_trips GROUP BY airport"""),
    "airport_trip_time": on_silver(AIRPORT_VIEW, f"""
        SELECT airport, pu AS pu_location_id, hour_of_day, count(*) AS trips,
          {wait_quantile(0.5, 'secs')} AS trip_sec_p50, {wait_quantile(0.9, 'secs')} AS trip_sec_p90
        FROM airport_trips WHERE direction = 'dropoff' GROUP BY 1, 2, 3"""),
    # outlines are cells of a grid 17 wide: neighbours share a side
    "neighbour_spill": on_silver(DEFICIT, """
        ids AS (SELECT DISTINCT 1 + c_custkey % 265 AS id FROM customer WHERE c_custkey % 7 NOT IN (0, 2)),
        treated AS (SELECT pu AS id FROM ranked WHERE zone_rank <= 8),
        beside AS (SELECT b.id, count(*) AS k FROM treated a JOIN ids x ON a.id = x.id JOIN ids b
            ON abs((a.id-1) % 17 - (b.id-1) % 17) + abs((a.id-1)//17 - (b.id-1)//17) = 1
          WHERE b.id NOT IN (SELECT id FROM treated) GROUP BY b.id)""", """
        SELECT pu AS pu_location_id, month, any_value(k) AS treated_neighbours, count(*) AS trips
        FROM silver JOIN beside ON pu = beside.id GROUP BY 1, 2"""),
}
