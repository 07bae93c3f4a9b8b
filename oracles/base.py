"""Common table expressions and small text builders for the oracle SQL."""

from __future__ import annotations

ZONES = """
zones AS (
  SELECT CAST(location_id AS INTEGER) AS location_id,
    CASE WHEN location_id=1 THEN 'EWR' WHEN location_id=264 THEN 'Unknown' WHEN location_id=265 THEN 'N/A'
         WHEN r_regionkey=0 THEN 'Manhattan' WHEN r_regionkey=1 THEN 'Brooklyn' WHEN r_regionkey=2 THEN 'Queens'
         WHEN r_regionkey=3 THEN 'Bronx' ELSE 'Staten Island' END AS borough,
    concat('Zone ', CAST(CASE WHEN location_id=57 THEN 56 WHEN location_id IN (104,105) THEN 103
                              ELSE location_id END AS VARCHAR)) AS zone,
    CASE WHEN location_id=1 THEN 'EWR' WHEN location_id>=264 THEN 'N/A'
         WHEN r_regionkey=0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
  FROM (SELECT n_nationkey + 25*k + 1 AS location_id, r_regionkey
        FROM nation JOIN region ON n_regionkey = r_regionkey
        CROSS JOIN range(11) AS t(k)) AS z
  WHERE location_id <= 265)
"""

TRIPS = """
h0 AS (
  SELECT *, l_orderkey*7919 + l_partkey*104729 + l_suppkey*611953 + l_linenumber*1299709 AS h,
    CAST(floor(l_extendedprice) AS BIGINT) AS price FROM lineitem),
h1 AS (
  SELECT *, TIMESTAMP '2025-01-01 00:00:00' + to_seconds(CAST(h % 41904000 AS BIGINT)) AS pickup_datetime,
    20 + (h*17) % 9000 AS trip_time,
    CASE WHEN h % 83 = 0 THEN -1 - h % 900 WHEN h % 997 = 0 THEN 7201 + h % 5000 ELSE (h*31) % 1499 END AS w,
    CASE WHEN h % 10007 = 0 THEN 'HV0004' WHEN l_returnflag = 'R' THEN 'HV0005' ELSE 'HV0003' END AS licence,
    CASE WHEN h % 3001 = 0 THEN 0 ELSE 300 + price % 9000 END AS base,
    CAST(1 + (l_suppkey*37 + l_orderkey) % 265 AS INTEGER) AS pu,
    CAST(1 + (h*7) % 265 AS INTEGER) AS dz
  FROM h0),
h2 AS (
  SELECT licence, pickup_datetime AS ts, pu, dz, CAST(trip_time AS BIGINT) AS secs, CAST(base AS BIGINT) AS base,
    'B' || CAST(l_suppkey AS VARCHAR) AS dispatching,
    CASE WHEN licence = 'HV0005' THEN NULL ELSE 'B' || CAST(l_suppkey AS VARCHAR) END AS originating,
    pickup_datetime + to_seconds(CAST(-w AS BIGINT)) AS req,
    pickup_datetime + to_seconds(CAST(CASE WHEN h % 2003 = 0 THEN trip_time - 3600 ELSE trip_time END AS BIGINT)) AS drp,
    CASE WHEN licence = 'HV0005' THEN NULL ELSE pickup_datetime - INTERVAL 30 SECOND END AS scene,
    CAST(CASE WHEN h % 4999 = 0 THEN 0 ELSE (trip_time * CASE WHEN h % 4001 = 0 THEN 150 ELSE 5 + (h*13) % 25 END * 1000) // 3600 END AS BIGINT) AS milli,
    CAST(CASE WHEN h % 9 = 0 THEN 694 ELSE 0 END AS BIGINT) AS tolls,
    CAST((base * 245) // 10000 AS BIGINT) AS bcf,
    CAST((base * CAST(round(l_tax*100) AS BIGINT)) // 100 AS BIGINT) AS tax,
    CAST(CASE WHEN h % 2 = 0 THEN 275 ELSE 0 END AS BIGINT) AS cong,
    CAST(CASE WHEN pu IN (1,132,138) THEN 250 ELSE 0 END AS BIGINT) AS apt,
    CAST(CASE WHEN h % 3 = 0 AND pickup_datetime >= TIMESTAMP '2025-01-05 00:00:00' THEN 150 ELSE 0 END AS BIGINT) AS cbd,
    CAST(CASE WHEN l_linenumber > 5 THEN CAST(l_quantity AS BIGINT)*20 ELSE 0 END AS BIGINT) AS tips,
    CAST((base * (70 + CAST(round(l_discount*100) AS BIGINT))) // 100 AS BIGINT) AS pay,
    (licence = 'HV0003' AND h % 40 = 0) AS shr,
    ((licence = 'HV0003' AND h % 80 = 0) OR h % 1009 = 0) AS shm,
    (h % 300 = 7) AS aar,
    (h % 350 = 7) AS wvr,
    ((h % 350 = 7 AND h % 11 <> 0) OR h % 12 = 5) AS wvm
  FROM h1),
trips AS (
  SELECT *, base + tolls + bcf + tax + cong + apt + cbd AS total,
    CASE licence WHEN 'HV0003' THEN 'Uber' WHEN 'HV0005' THEN 'Lyft' ELSE licence END AS operator,
    CAST(date_diff('second', req, ts) AS BIGINT) AS wait_sec,
    CAST(date_diff('second', ts, drp) AS BIGINT) AS stamp_sec,
    CAST(ts AS DATE) AS trip_date,
    CAST(date_trunc('month', ts) AS DATE) AS month,
    CAST(hour(ts) AS INTEGER) AS hour_of_day,
    CAST(isodow(ts) AS INTEGER) AS day_of_week,
    CAST(year(ts)*100 + month(ts) AS INTEGER) AS ym
  FROM h2)
"""

SILVER = """
silver AS (
  SELECT *, CASE WHEN wait_sec BETWEEN 0 AND 7200 THEN wait_sec END AS wait,
    NOT (shr OR shm OR aar OR wvr OR wvm) AS regular
  FROM trips
  WHERE milli > 0 AND secs >= 30 AND base > 0 AND pay > 0 AND milli * 3600 <= 100 * 1000 * secs)
"""


def over(*parts: str) -> str:
    """Full statement from named common tables and a final SELECT."""
    *ctes, final = parts
    return "WITH " + ",\n".join(x.strip() for x in ctes) + "\n" + final.strip()


def on_trips(*parts: str) -> str:
    return over(TRIPS, *parts)


def on_silver(*parts: str) -> str:
    return over(TRIPS, SILVER, *parts)


def on_silver_zones(*parts: str) -> str:
    return over(TRIPS, SILVER, ZONES, *parts)


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def total(x: str) -> str:
    """Integer sum; 0 for an empty group."""
    return big(f"coalesce(sum({x}), 0)")


def hits(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def rate(num: str, den: str, digits: int) -> str:
    """num/den rounded half to even on integers, as a double; NULL when den = 0."""
    n = f"(abs(CAST({num} AS HUGEINT)) * {10**digits})"
    d = f"nullif(CAST({den} AS HUGEINT), 0)"
    return (
        f"CAST(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END * ({n} // {d} + "
        f"CASE WHEN 2*({n} % {d}) > {d} OR (2*({n} % {d}) = {d} AND ({n} // {d}) % 2 = 1) "
        f"THEN 1 ELSE 0 END) AS DOUBLE) / {10**digits}"
    )


def usd(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


def wait_quantile(q: float, col: str = "wait") -> str:
    return f"round(quantile_cont({col}, {q}), 1)"


def cents_quantile(q: float, col: str) -> str:
    return f"round_even(round(quantile_cont({col}, {q}), 6), 0) / 100"
