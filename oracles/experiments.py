"""Oracle SQL of experiment tables and zone geometry."""

from __future__ import annotations

from oracles.base import on_silver, on_trips, over, rate

P = 2147483647


def arm(user: str, salt: int) -> str:
    x = f"(({user} % {P}) + {salt}) % {P}"
    for m in (48271, 69621):
        x = f"((({x}) * (({x}) + {m + salt})) % {P})"
    return f"CAST((({x}) // 256) % 2 AS INTEGER)"


USERS = f"users AS (SELECT DISTINCT c_custkey, {arm('c_custkey', 17)} AS arm FROM customer)"
PER_USER = """per_user AS (
  SELECT c_custkey, arm, coalesce(value, 0) AS value, coalesce(facts, 0) AS facts
  FROM users LEFT JOIN (SELECT o_custkey, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS value, count(*) AS facts
                        FROM orders GROUP BY 1) o ON c_custkey = o_custkey)"""
VARIANCE = """CAST(n * s2 - s1 * s1 AS DOUBLE) / nullif(CAST(n * (n - 1) AS DOUBLE), 0)"""

CELL = """cell AS (
  SELECT *, CAST((-7430 + 5*col) AS DOUBLE) / 100 AS x0, CAST((-7430 + 5*(col+1)) AS DOUBLE) / 100 AS x1,
    CAST((4050 + 4*line) AS DOUBLE) / 100 AS y0, CAST((4050 + 4*(line+1)) AS DOUBLE) / 100 AS y1
  FROM (SELECT c_custkey, id, (id-1) % 17 AS col, (id-1) // 17 AS line
        FROM (SELECT c_custkey, 1 + c_custkey % 265 AS id FROM customer)))"""
FULL = "concat('[[[', y0, ', ', x0, '], [', y0, ', ', x1, '], [', y1, ', ', x1, '], [', y1, ', ', x0, '], [', y0, ', ', x0, ']]]')"
HALF = "concat('[[[', y0, ', ', x0, '], [', y0, ', ', x1, '], [', y1, ', ', x1, '], [', y0, ', ', x0, ']]]')"
NAMES = "CAST(id AS INTEGER) AS location_id, concat('Zone ', id) AS zone, concat('Row ', line) AS borough"
STEPS = ("view", "click", "signup", "purchase")


def _funnel() -> str:
    """Each step found by an as-of join: the next event of its kind from the time reached."""
    first = f"r0 AS (SELECT user_id, min(ts) AS ts FROM events WHERE event_type = '{STEPS[0]}' GROUP BY user_id)"
    later = [
        f"r{i} AS (SELECT r.user_id, e.ts FROM r{i - 1} r ASOF JOIN (SELECT user_id, ts FROM events "
        f"WHERE event_type = '{s}') e ON r.user_id = e.user_id AND r.ts <= e.ts)"
        for i, s in enumerate(STEPS) if i
    ]
    sizes = ", ".join(f"(SELECT count(*) FROM r{i}) AS n{i}" for i in range(len(STEPS)))
    rows = " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS INTEGER) AS step_order, '{s}' AS step, n{i} AS users, "
        f"{rate(f'100 * n{i}', f'n{max(i - 1, 0)}', 4)} AS from_previous_pct, "
        f"{rate(f'100 * n{i}', 'n0', 4)} AS from_first_pct FROM c"
        for i, s in enumerate(STEPS)
    )
    return over(first, *later, f"c AS (SELECT {sizes})", rows)


SQL = {
    "ab_assign": over(USERS, "SELECT c_custkey, arm FROM users"),
    "switchback_assign": on_silver("""
        k AS (SELECT pu, hour_of_day, CAST(date_diff('day', DATE '2024-12-30', trip_date) // 7 AS INTEGER) AS week,
              count(*) AS trips FROM silver GROUP BY ALL)""", """
        SELECT CAST(z.pu AS INTEGER) AS pu_location_id, CAST(h.hour_of_day AS INTEGER) AS hour_of_day,
          CAST(w.week AS INTEGER) AS week_index, coalesce(k.trips, 0) AS trips,
          CASE WHEN (w.week + z.pu) % 2 = 0 THEN 'on' ELSE 'off' END AS arm
        FROM range(1, 266) z(pu) CROSS JOIN range(24) h(hour_of_day)
        CROSS JOIN (SELECT unnest(range(min(week), max(week) + 1)) AS week FROM k) w
        LEFT JOIN k ON k.pu = z.pu AND k.hour_of_day = h.hour_of_day AND k.week = w.week"""),
    "switchback_effect": on_silver("""
        k AS (SELECT pu, hour_of_day, CAST(date_diff('day', DATE '2024-12-30', trip_date) // 7 AS INTEGER) AS week,
              count(*) FILTER (wait > 900) AS late, count(wait) AS waited FROM silver GROUP BY ALL),
        units AS (SELECT CASE WHEN (w.week + z.pu) % 2 = 0 THEN 'on' ELSE 'off' END AS arm,
              CAST(coalesce(late, 0) AS HUGEINT) AS y, CAST(coalesce(waited, 0) AS HUGEINT) AS x
            FROM range(1, 266) z(pu) CROSS JOIN range(24) h(hour_of_day)
            CROSS JOIN (SELECT unnest(range(min(week), max(week) + 1)) AS week FROM k) w
            LEFT JOIN k ON k.pu = z.pu AND k.hour_of_day = h.hour_of_day AND k.week = w.week),
        s AS (SELECT arm, count(*) AS n, sum(y)::DOUBLE AS y, sum(x)::DOUBLE AS x, sum(y * y)::DOUBLE AS yy, sum(x * y)::DOUBLE AS xy,
              sum(x * x)::DOUBLE AS xx FROM units GROUP BY arm),
        r AS (SELECT *, y / x AS ratio,
              sqrt(n::DOUBLE / (n::DOUBLE - 1) * (greatest(yy - 2 * (y / x) * xy + (y / x) * (y / x) * xx, 0) / (x * x))) AS error FROM s)""", """
        SELECT a.arm, a.n AS units, a.y::BIGINT AS late, a.x::BIGINT AS waited, round(a.ratio, 6) AS ratio, round(a.error, 8) AS standard_error,
          CASE WHEN a.arm = 'on' THEN round(a.ratio - b.ratio, 6) END AS difference,
          CASE WHEN a.arm = 'on' THEN round(sqrt(a.error * a.error + b.error * b.error), 8) END AS difference_error
        FROM r a, r b WHERE b.arm = 'off'"""),
    "clock_changes": on_trips("""
        d(day, shift_seconds) AS (VALUES (DATE '2025-03-09', 3600), (DATE '2025-11-02', -3600), (DATE '2026-03-08', 3600), (DATE '2026-11-01', -3600)),
        n AS (SELECT *, lead(day) OVER (ORDER BY day) - day AS days_to_next FROM d)""", """
        SELECT day, shift_seconds::BIGINT AS shift_seconds, days_to_next::INTEGER AS days_to_next, count(*) AS trips
        FROM n JOIN trips ON trip_date = day GROUP BY 1, 2, 3"""),
    "itt_summary": over(USERS, PER_USER, f"""
        m AS (SELECT arm, count(*) AS n, sum(CAST(value AS HUGEINT)) AS s1, sum(CAST(value AS HUGEINT) * value) AS s2 FROM per_user GROUP BY arm),
        v AS (SELECT arm, n, {rate('s1', 'n * 100', 4)} AS mean, {VARIANCE} / 10000 AS variance FROM m)""", """
        SELECT a.arm, a.n, a.mean, round(a.variance, 2) AS variance, round(a.mean - b.mean, 4) AS diff_to_control,
          CASE WHEN a.arm <> 0 THEN round(sqrt(b.variance / b.n + a.variance / a.n), 4) END AS standard_error
        FROM v a CROSS JOIN (SELECT * FROM v WHERE arm = 0) b"""),
    "sample_size": on_silver(
        "m AS (SELECT operator, count(*) AS n, sum(CAST(tips AS HUGEINT)) AS s1, sum(CAST(tips AS HUGEINT) * tips) AS s2 FROM silver GROUP BY operator)",
        f"v AS (SELECT *, {VARIANCE} AS variance, CAST(s1 AS DOUBLE) / n * 0.03::DOUBLE AS delta FROM m)", f"""
        SELECT operator, n AS trips, {rate('s1', 'n * 100', 4)} AS mean_tip, round(sqrt(variance) / 100, 4) AS sd_tip,
          CASE WHEN s1 > 0 THEN CAST(ceil(2 * pow(1.959964::DOUBLE + 0.841621::DOUBLE, 2) * variance / (delta * delta)) AS BIGINT) END AS n_per_arm
        FROM v"""),
    "balance_check": over(USERS, """
        r AS (SELECT arm, o_orderpriority, o_totalprice, o_orderdate, c_nationkey, c_mktsegment
              FROM orders JOIN customer ON o_custkey = customer.c_custkey JOIN users ON users.c_custkey = customer.c_custkey),
        l AS (SELECT arm, 'zone' AS covariate, CAST(c_nationkey AS VARCHAR) AS level FROM r
          UNION ALL SELECT arm, 'weekday', CAST(isodow(o_orderdate) AS VARCHAR) FROM r
          UNION ALL SELECT arm, 'price_50k', CAST(CAST(floor(o_totalprice / 50000) AS BIGINT) AS VARCHAR) FROM r
          UNION ALL SELECT arm, 'user_type', c_mktsegment FROM r),
        k AS (SELECT covariate, level, count(*) FILTER (WHERE arm = 0) AS n0, count(*) FILTER (WHERE arm = 1) AS n1 FROM l GROUP BY 1, 2),
        s AS (SELECT *, CAST(n0 AS DOUBLE) / sum(n0) OVER (PARTITION BY covariate) AS p0,
                        CAST(n1 AS DOUBLE) / sum(n1) OVER (PARTITION BY covariate) AS p1 FROM k)""", """
        SELECT covariate, level, n0 AS n_control, n1 AS n_test, round(p0, 6) AS share_control, round(p1, 6) AS share_test,
          round((p1 - p0) / nullif(sqrt((p0 * (1 - p0) + p1 * (1 - p1)) / 2), 0), 4) AS std_difference
        FROM s"""),
    "session_dedupe": over("""
        g AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 1800000000 THEN 0 ELSE 1 END AS s
              FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        n AS (SELECT user_id, ts, CAST(sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM g)""", """
        SELECT user_id, session, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events FROM n GROUP BY 1, 2"""),
    "funnel_steps": _funnel(),
    "exclude_days": on_silver(f"""
        SELECT trip_date, operator, count(*) AS trips, {rate('sum(tips)', 'count(*) * 100', 4)} AS avg_tip FROM silver
        WHERE trip_date NOT IN (DATE '2026-01-25', DATE '2026-02-23')
          AND trip_date NOT BETWEEN DATE '2025-12-01' AND DATE '2025-12-31'
        GROUP BY trip_date, operator"""),
    "guardrails": over(USERS, PER_USER, f"""
        a AS (SELECT arm, {rate('sum(value)', 'count(*) * 100', 4)} AS revenue, {rate('sum(facts)', 'count(*)', 4)} AS facts,
            {rate('100 * count(*) FILTER (WHERE facts > 0)', 'count(*)', 4)} AS active FROM per_user GROUP BY arm),
        w AS (SELECT c.revenue AS r0, t.revenue AS r1, c.facts AS f0, t.facts AS f1, c.active AS a0, t.active AS a1
              FROM (SELECT * FROM a WHERE arm = 0) c CROSS JOIN (SELECT * FROM a WHERE arm = 1) t),
        m AS (SELECT 'revenue_per_user' AS metric, r0 AS control, r1 AS test, 1 AS max_drop_pct FROM w
          UNION ALL SELECT 'orders_per_user', f0, f1, 2 FROM w UNION ALL SELECT 'active_users_pct', a0, a1, 5 FROM w)""", """
        SELECT metric, control, test, max_drop_pct,
          CASE WHEN test >= control * (1 - max_drop_pct / 100.0::DOUBLE) THEN 'ok' ELSE 'violated' END AS verdict FROM m"""),
    "geo_field_resolve": """
        SELECT CASE c_custkey % 3 WHEN 0 THEN 'LocationID' WHEN 1 THEN 'location_id' ELSE 'OBJECTID' END AS id_field,
          CASE c_custkey % 2 WHEN 0 THEN 'zone' ELSE 'Zone_Name' END AS zone_field, 'Borough' AS borough_field,
          true AS complete, count(*) AS features
        FROM customer GROUP BY 1, 2""",
    "geo_swap_coords": over(CELL, f"""
        SELECT {NAMES}, CASE c_custkey % 7 WHEN 1 THEN 'MultiPolygon' WHEN 2 THEN 'Point' ELSE 'Polygon' END AS type,
          CASE c_custkey % 7 WHEN 1 THEN concat('[', {FULL}, ', ', {HALF}, ']')
            WHEN 2 THEN concat('[', y0, ', ', x0, ']') ELSE {FULL} END AS coordinates
        FROM cell WHERE c_custkey % 7 <> 0"""),
    "geo_errors": """SELECT count(*) AS features, count(*) FILTER (WHERE c_custkey % 7 <> 0) AS converted,
          count(*) FILTER (WHERE c_custkey % 7 = 0) AS errors FROM customer""",
    "geo_explode_polygons": over(CELL, f"""
        SELECT {NAMES}, CAST(0 AS INTEGER) AS part, {FULL} AS coordinates FROM cell WHERE c_custkey % 7 NOT IN (0, 2)
        UNION ALL SELECT {NAMES}, 1, {HALF} FROM cell WHERE c_custkey % 7 = 1"""),
    "geo_zone_csv": over(CELL, f"""
        SELECT CAST(id AS INTEGER) AS LocationID, concat('Zone ', id) AS zone, concat('Row ', line) AS borough, {FULL} AS coordinates
        FROM cell WHERE c_custkey % 7 NOT IN (0, 2)
        UNION ALL SELECT CAST(id AS INTEGER), concat('Zone ', id), concat('Row ', line), {HALF} FROM cell WHERE c_custkey % 7 = 1"""),
}
