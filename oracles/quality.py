"""Oracle SQL of row rules, joins, profiles, quality checks, sources and sinks."""

from __future__ import annotations

from oracles.base import TRIPS, hits, on_silver, on_silver_zones, on_trips, rate, usd, wait_quantile
from oracles.marts import AIRPORT_VIEW, BUCKET14, LABEL16, LABELS14, SEGMENT
from oracles.marts import SQL as MART_SQL
from oracles.reports import pct

# Columns and types of the trip contract.
CONTRACT = [
    ("hvfhs_license_num", "string"), ("dispatching_base_num", "string"),
    ("originating_base_num", "string"), ("request_datetime", "timestamp_ntz"),
    ("on_scene_datetime", "timestamp_ntz"), ("pickup_datetime", "timestamp_ntz"),
    ("dropoff_datetime", "timestamp_ntz"), ("PULocationID", "int"), ("DOLocationID", "int"),
    ("trip_miles", "double"), ("trip_time", "bigint"), ("base_passenger_fare", "double"),
    ("tolls", "double"), ("bcf", "double"), ("sales_tax", "double"),
    ("congestion_surcharge", "double"), ("airport_fee", "double"), ("tips", "double"),
    ("driver_pay", "double"), ("shared_request_flag", "boolean"),
    ("shared_match_flag", "boolean"), ("access_a_ride_flag", "boolean"),
    ("wav_request_flag", "boolean"), ("wav_match_flag", "boolean"),
    ("cbd_congestion_fee", "double"),
]
# columns of the contract in the names of the derived table
SOURCE = {
    "originating_base_num": "originating", "on_scene_datetime": "scene",
}

SPRING = " OR ".join(
    f"(ts >= TIMESTAMP '{d}' - INTERVAL 1 DAY AND ts < TIMESTAMP '{d}' + INTERVAL 2 HOUR "
    f"AND drp >= TIMESTAMP '{d}' + INTERVAL 3 HOUR AND drp < TIMESTAMP '{d}' + INTERVAL 1 DAY)"
    for d in ("2025-03-09", "2026-03-08")
)
SPRING_DUR = f"(({SPRING}) AND abs(secs - stamp_sec + 3600) <= 60)"
FALL_DUR = "(trip_date = DATE '2025-11-02' AND abs(secs - stamp_sec - 3600) <= 60)"


def gap(col: str) -> str:
    return "(" + " OR ".join(
        f"({col} >= TIMESTAMP '{d} 02:00:00' AND {col} < TIMESTAMP '{d} 03:00:00')"
        for d in ("2025-03-09", "2026-03-08")
    ) + ")"


MPH_VALUE = rate("sum(milli) * 36", "sum(secs) * 10", 2)
REPEATED = "(trip_date = DATE '2025-11-02' AND hour_of_day = 1)"

# Groups, names and severities of the check table.
ODS = [
    ("zones", "PULocationID вне 1-265", "pu NOT BETWEEN 1 AND 265", "error"),
    ("zones", "DOLocationID вне 1-265", "dz NOT BETWEEN 1 AND 265", "error"),
    ("zones", "PULocationID = 264 (Unknown)", "pu = 264", "info"),
    ("zones", "DOLocationID = 264 (Unknown)", "dz = 264", "info"),
    ("zones", "PULocationID = 265 (Outside of NYC)", "pu = 265", "info"),
    ("zones", "DOLocationID = 265 (Outside of NYC)", "dz = 265", "info"),
    ("zones", "посадка и высадка в одной зоне", "pu = dz", "info"),
    ("geo", "trip_miles < 0", "milli < 0", "error"),
    ("geo", "trip_time < 0", "secs < 0", "error"),
    ("geo", "trip_miles = 0", "milli = 0", "warning"),
    ("geo", "trip_miles > 100", "milli > 100000", "info"),
    ("geo", "скорость > 100 миль/ч", "secs > 0 AND milli * 3600 > 100000 * secs", "warning"),
    ("time", "DST fall-back: dropoff < pickup", f"drp < ts AND {FALL_DUR}", "info"),
    ("time", "dropoff < pickup, не объяснён DST", f"drp < ts AND NOT {FALL_DUR}", "warning"),
    ("time", "dropoff_datetime = pickup_datetime", "drp = ts", "warning"),
    ("time", "pickup_datetime < request_datetime", "ts < req", "warning"),
    ("time", "час 01 в ночь возврата на зимнее время", REPEATED, "info"),
    ("time", "DST spring-forward: request в несуществующем 02:xx", gap("req"), "warning"),
    ("time", "DST spring-forward: pickup в несуществующем 02:xx", gap("ts"), "warning"),
    ("time", "DST spring-forward: duration_diff ≈ -3600", SPRING_DUR, "info"),
    ("time", "DST fall-back: duration_diff ≈ +3600", FALL_DUR, "info"),
    ("time", "trip_time < 10 секунд", "secs < 10", "warning"),
    ("time", "trip_time > 6 часов", "secs > 21600", "warning"),
    ("time", "|trip_time - факт| > 60 с, не DST",
     f"abs(secs - stamp_sec) > 60 AND NOT ({SPRING_DUR} OR {FALL_DUR})", "warning"),
    ("time", "pickup вне окна 2025-01..2026-04",
     "ts < TIMESTAMP '2025-01-01' OR ts >= TIMESTAMP '2026-05-01'", "error"),
    ("time", "request раньше окна", "req < TIMESTAMP '2025-01-01'", "info"),
    ("time", "dropoff позже окна", "drp >= TIMESTAMP '2026-05-01'", "info"),
    ("money", "base_passenger_fare < 0", "base < 0", "warning"),
    ("money", "driver_pay < 0", "pay < 0", "warning"),
    ("money", "tips < 0", "tips < 0", "error"),
    ("money", "tolls < 0", "tolls < 0", "error"),
    ("money", "bcf < 0", "bcf < 0", "error"),
    ("money", "sales_tax < 0", "tax < 0", "error"),
    ("money", "congestion_surcharge < 0", "cong < 0", "error"),
    ("money", "airport_fee < 0", "apt < 0", "error"),
    ("money", "cbd_congestion_fee < 0", "cbd < 0", "error"),
    ("money", "base_passenger_fare = 0", "base = 0", "warning"),
    ("money", "cbd_congestion_fee до 05.01.2025", "cbd <> 0 AND ts < TIMESTAMP '2025-01-05'", "info"),
    ("money", "congestion_surcharge и cbd одновременно", "cong > 0 AND cbd > 0", "info"),
    ("flags", "wav_request без wav_match", "wvr AND NOT wvm", "warning"),
    ("flags", "wav_match без wav_request", "NOT wvr AND wvm", "info"),
    ("flags", "orphan_matches", "NOT shr AND shm", "warning"),
    ("flags", "wav_request и access_a_ride вместе", "wvr AND aar", "info"),
]
MAXIMA = {
    "base_passenger_fare": ("base", 100), "driver_pay": ("pay", 100), "tips": ("tips", 100),
    "tolls": ("tolls", 100), "congestion_surcharge": ("cong", 100), "bcf": ("bcf", 100),
    "airport_fee": ("apt", 100), "sales_tax": ("tax", 100), "cbd_congestion_fee": ("cbd", 100),
    "trip_miles": ("milli", 1000), "trip_time": ("secs", 1),
}
QC = [
    ("negative fare", "base < 0", "flagged"), ("fare <= 0", "base <= 0", "flagged"),
    ("trip_miles = 0", "milli = 0", "flagged"), ("trip_miles > 100", "milli > 100000", "retained"),
    ("trip_time > 6h", "secs > 21600", "flagged"), ("dropoff <= pickup", "drp <= ts", "flagged"),
    ("pickup < request", "ts < req", "retained"),
    ("service zones 264/265", "pu >= 264 OR dz >= 264", "retained"),
    ("on_scene is null", "scene IS NULL", "retained"),
]


def _rows(values: list[str], names: str) -> str:
    return f"(VALUES {', '.join(values)}) AS k({names})"


def _counted(checks: list, group_by: str | None) -> tuple[str, str]:
    """CTE with one counter per check, and the list that reads counter i."""
    counters = ", ".join(f"{hits(chk[-2])} AS c{i}" for i, chk in enumerate(checks))
    keys = f"{group_by}, " if group_by else ""
    tail = f" GROUP BY {group_by}" if group_by else ""
    cte = f"counted AS (SELECT {keys}count(*) AS total, {counters} FROM trips{tail})"
    return cte, "[" + ", ".join(f"c{i}" for i in range(len(checks))) + "]"


ODS_CTE, ODS_LIST = _counted(ODS, None)
QC_CTE, QC_LIST = _counted(QC, "ym")
ODS_NAMES = _rows(
    [f"({i + 1}, '{g}', '{n}', '{s}')" for i, (g, n, _, s) in enumerate(ODS)],
    "i, check_group, check_name, severity",
)
QC_NAMES = _rows(
    [f"({i + 1}, '{n}', '{a}')" for i, (n, _, a) in enumerate(QC)], "i, metric_name, action_taken"
)
QC_SELECT = f"""SELECT ym AS partition_id, metric_name, {QC_LIST}[i] AS rows_affected,
    {rate(f'100 * {QC_LIST}[i]', 'total', 4)} AS share_pct, action_taken FROM counted CROSS JOIN {QC_NAMES}"""
MAX_LIST = "[" + ", ".join(
    f"max({c}) * {1000 // u}" for c, u in MAXIMA.values()
) + "]"  # all in thousandths
REPEATS = """repeats AS (
  SELECT ym, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, CAST(sum(n) AS BIGINT) AS total FROM (
    SELECT ym, count(*) AS n FROM trips
    GROUP BY ym, licence, dispatching, originating, req, scene, ts, drp, pu, dz, milli, secs, base, tolls, bcf,
      tax, cong, apt, tips, pay, shr, shm, aar, wvr, wvm, cbd) GROUP BY ym)"""
NULLS = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n_{c}" for c in SOURCE.values())
COLUMN_LIST = _rows([f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(CONTRACT)], "i, column_name, t")
HISTOGRAM_LINES = f"""
  SELECT '"' || CAST(month AS VARCHAR) || '","' || operator || '",' || bucket_order || ',"' || wait_bucket || '",' || trips_with_wait AS value
  FROM ({MART_SQL['mart_wait_histogram']})
  UNION ALL SELECT '"month","operator","bucket_order","wait_bucket","trips_with_wait"'"""


# the same flaws by class of duration as the stand-in tables have
_LATEST = TRIPS[TRIPS.index("trips AS ("):].replace("trips AS (", "flawed AS (").replace("FROM h2", "FROM f2")
FLAWED = f"""
f1 AS (SELECT *, secs % 211 AS k FROM h2),
f2 AS (
  SELECT licence, dispatching, originating, scene, shr, shm,
    CASE k WHEN 13 THEN ts - INTERVAL 1000 DAY WHEN 20 THEN TIMESTAMP '2025-11-02 01:50:00' WHEN 21 THEN TIMESTAMP '2025-03-09 01:50:00'
      WHEN 22 THEN TIMESTAMP '2025-03-09 02:30:00' WHEN 24 THEN TIMESTAMP '2025-01-02 03:00:00' ELSE ts END AS ts,
    CASE k WHEN 0 THEN 0 ELSE pu END AS pu, CASE k WHEN 1 THEN 300 ELSE dz END AS dz,
    CASE k WHEN 3 THEN -secs WHEN 15 THEN 5 WHEN 16 THEN 30000 WHEN 20 THEN 1200 WHEN 21 THEN 1200 ELSE secs END AS secs,
    CASE k WHEN 4 THEN -base - 1 ELSE base END AS base, CASE k WHEN 5 THEN -pay - 1 ELSE pay END AS pay,
    CASE k WHEN 18 THEN TIMESTAMP '2024-12-31 23:00:00' WHEN 23 THEN TIMESTAMP '2025-03-09 02:10:00' ELSE req END AS req,
    CASE k WHEN 14 THEN ts WHEN 19 THEN TIMESTAMP '2026-05-02 00:00:00' WHEN 20 THEN TIMESTAMP '2025-11-02 01:10:00'
      WHEN 21 THEN TIMESTAMP '2025-03-09 03:10:00' ELSE drp END AS drp,
    CASE k WHEN 2 THEN -milli - 1 WHEN 17 THEN 150000 ELSE milli END AS milli,
    CASE k WHEN 6 THEN -100 ELSE tips END AS tips, CASE k WHEN 7 THEN -1 ELSE tolls END AS tolls, CASE k WHEN 8 THEN -1 ELSE bcf END AS bcf,
    CASE k WHEN 9 THEN -1 ELSE tax END AS tax, CASE k WHEN 10 THEN -1 ELSE cong END AS cong, CASE k WHEN 11 THEN -1 ELSE apt END AS apt,
    CASE k WHEN 12 THEN -1 WHEN 24 THEN 150 ELSE cbd END AS cbd,
    aar OR k = 25 AS aar, wvr OR k IN (25, 26) AS wvr, wvm AND k <> 26 AS wvm
  FROM f1),
{_LATEST}"""
FILES = """
w AS (SELECT ym, k, originating, scene, CASE k WHEN 30 THEN 2 WHEN 31 THEN 3 ELSE 1 END AS copies FROM (SELECT *, secs % 211 AS k FROM trips)),
n AS (SELECT ym, sum(copies)::BIGINT AS rows, count(*) FILTER (k = 33) AS empty, count(*) FILTER (k = 32) AS tips, count(*) FILTER (k IN (33, 34)) AS foreign_rows,
    coalesce(sum(copies) FILTER (k = 33 OR originating IS NULL), 0)::BIGINT AS originating, coalesce(sum(copies) FILTER (k = 33 OR scene IS NULL), 0)::BIGINT AS scene,
    (sum(copies - 1) + greatest(count(*) FILTER (k = 33) - 1, 0))::BIGINT AS copies FROM w GROUP BY ym)"""


def flawed(sql: str) -> str:
    """A query on trips, on the flawed ones."""
    at = sql.index("counted AS (")
    return sql[:at] + FLAWED.strip() + ",\n" + sql[at:].replace("FROM trips", "FROM flawed")


def outcomes(**columns: str) -> str:
    names = ", ".join(f"{v} AS {k}" for k, v in columns.items())
    return on_trips(f"SELECT {names}, count(*) AS trips FROM trips GROUP BY ALL")


SQL = {
    "expr_operator": outcomes(hvfhs_license_num="licence", operator="operator"),
    "expr_wait": outcomes(wait_sec="wait_sec"),
    "filter_silver": on_silver(f"""
        SELECT ym AS pickup_month, n AS bronze_trips, s AS silver_trips, {pct('s', 'n')} AS silver_pct
        FROM (SELECT ym, count(*) AS n FROM trips GROUP BY ym) JOIN (SELECT ym, count(*) AS s FROM silver GROUP BY ym) USING (ym)"""),
    "expr_wait_valid": on_trips("""
        SELECT wait_sec BETWEEN 0 AND 7200 AS wait_valid, count(*) AS trips, min(wait_sec) AS least, max(wait_sec) AS most
        FROM trips GROUP BY 1"""),
    "expr_scheduled": outcomes(operator="operator", scheduled="wait_sec < 0"),
    "expr_duration_valid": outcomes(operator="operator", duration_valid="drp > ts"),
    "expr_total_fare": outcomes(total_fare=usd("total")),
    "expr_time_parts": outcomes(
        trip_date="trip_date", month="month", hour_of_day="hour_of_day", day_of_week="day_of_week",
        pickup_month="ym",
    ),
    "expr_segment": on_silver_zones(f"""
        SELECT pu AS pu_location_id, dz AS do_location_id, {SEGMENT} AS segment, count(*) AS trips
        FROM trips LEFT JOIN zones zp ON pu = zp.location_id LEFT JOIN zones zd ON dz = zd.location_id GROUP BY 1, 2, 3"""),
    "bucket_wait14": on_trips(f"""
        SELECT bucket_order, {LABELS14}[bucket_order] AS wait_bucket, count(*) AS trips, min(wait) AS least, max(wait) AS most
        FROM (SELECT wait_sec AS wait, CAST({BUCKET14.replace('wait', 'wait_sec')} AS INTEGER) AS bucket_order
              FROM trips WHERE wait_sec BETWEEN 0 AND 7200) GROUP BY bucket_order"""),
    "bucket_wait16": on_trips(f"""
        SELECT bucket_order, {LABEL16} AS wait_bucket, count(*) AS trips, min(wait_sec) AS least, max(wait_sec) AS most
        FROM (SELECT wait_sec, CAST(least(wait_sec // 60, 15) + 1 AS INTEGER) AS bucket_order
              FROM trips WHERE wait_sec BETWEEN 0 AND 7200) GROUP BY bucket_order"""),
    "bucket_miles": on_trips("""
        SELECT CAST(least(milli // 1000, 60) AS INTEGER) AS mile_bin, count(*) AS trips,
          CAST(min(milli) AS DOUBLE) / 1000 AS least, CAST(max(milli) AS DOUBLE) / 1000 AS most FROM trips GROUP BY 1"""),
    "dst_flags": outcomes(
        spring_duration=SPRING_DUR, fall_duration=FALL_DUR, request_in_gap=gap("req"),
        pickup_in_gap=gap("ts"), repeated_hour=REPEATED,
    ),
    "expr_duration_diff": outcomes(duration_diff="secs - stamp_sec"),
    "expr_airport_name": outcomes(
        pu_location_id="pu",
        airport="CASE pu WHEN 132 THEN 'JFK' WHEN 138 THEN 'LaGuardia' WHEN 1 THEN 'Newark' END",
    ),
    "cohort_regular": on_silver("""
        SELECT operator, wait IS NOT NULL AND regular AS cohort_regular, count(*) AS trips FROM silver GROUP BY 1, 2"""),
    "join_zone_pickup": on_silver_zones("""
        SELECT pu AS pu_location_id, z.zone AS pu_zone_name, z.borough AS pu_borough, count(*) AS trips
        FROM silver LEFT JOIN zones z ON pu = z.location_id GROUP BY 1, 2, 3"""),
    "join_zone_both": on_silver_zones("""
        SELECT zp.borough AS pu_borough, zd.borough AS do_borough, count(*) AS trips
        FROM silver LEFT JOIN zones zp ON pu = zp.location_id LEFT JOIN zones zd ON dz = zd.location_id GROUP BY 1, 2"""),
    "join_totals": on_silver("""
        f AS (SELECT month, operator, hour_of_day, count(*) AS trips FROM silver GROUP BY 1, 2, 3),
        o AS (SELECT month, operator, count(*) AS operator_trips FROM silver GROUP BY 1, 2),
        m AS (SELECT month, count(*) AS month_trips FROM silver GROUP BY 1)""", f"""
        SELECT *, {pct('trips', 'operator_trips')} AS share_pct
        FROM f JOIN o USING (month, operator) JOIN m USING (month)"""),
    "union_directions": on_silver(AIRPORT_VIEW, """
        SELECT airport, direction, pu IN (1,132,138) AND dz IN (1,132,138) AS both_ends, count(*) AS trips
        FROM airport_trips GROUP BY 1, 2, 3"""),
    "agg_functions": on_silver(f"""
        SELECT month, operator, count(*) AS trips, {hits('wait_sec < 0')} AS scheduled,
          CAST(coalesce(sum(wait) FILTER (WHERE shr), 0) AS BIGINT) AS shared_wait_sec, max(secs) AS max_secs,
          count(DISTINCT (pu, wait)) AS zone_waits, {wait_quantile(0.5)} AS wait_p50,
          {rate('sum(secs)', 'count(*)', 4)} AS avg_secs,
          {rate(hits('shr AND wait > 600'), hits('shr AND wait IS NOT NULL'), 4)} AS share_shared_late, {MPH_VALUE} AS mph
        FROM silver GROUP BY month, operator"""),
    "sort_table_keys": on_trips("""
        SELECT ym AS pickup_month, count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM trips GROUP BY ym"""),
    "read_zone_range": on_trips("""
        SELECT ym AS pickup_month, pu AS pu_location_id, count(*) AS trips, max(ts) AS last_pickup
        FROM trips WHERE pu BETWEEN 120 AND 140 GROUP BY ym, pu"""),
    "sort_dims_first4": MART_SQL["mart_airports"],
    "val_columns": on_trips(f"""
        SELECT m.ym AS file_month, column_name, 'ok' AS status, CAST(i AS INTEGER) AS expected_position,
          CAST(i AS INTEGER) AS actual_position FROM (SELECT DISTINCT ym FROM trips) m CROSS JOIN {COLUMN_LIST}"""),
    "val_type_drift": on_trips("f AS (SELECT DISTINCT ym, ym % 3 AS state FROM trips)", f"""
        SELECT ym AS file_month, column_name, want AS expected_type,
          CASE WHEN missing THEN NULL WHEN text THEN 'string' WHEN short THEN 'int' ELSE want END AS actual_type,
          CASE WHEN missing THEN 'missing' WHEN text OR short THEN 'type' ELSE 'ok' END AS status
        FROM (SELECT ym, column_name, CASE WHEN column_name LIKE '%\\_flag' ESCAPE '\\' THEN 'string' ELSE t END AS want,
                state = 1 AND column_name = 'tolls' AS missing, state = 1 AND column_name = 'tips' AS text,
                state = 2 AND column_name = 'trip_time' AS short
              FROM f CROSS JOIN {COLUMN_LIST})
        UNION ALL SELECT ym, 'note', NULL, 'string', 'extra' FROM f WHERE state = 2"""),
    "val_null_profile": on_trips(f"n AS (SELECT ym, count(*) AS total, {NULLS} FROM trips GROUP BY ym)", f"""
        SELECT ym AS file_month, column_name, c AS null_count, {pct('c', 'total')} AS null_pct, true AS expected
        FROM (SELECT ym, total, column_name, CASE column_name WHEN 'originating_base_num' THEN n_originating
                WHEN 'on_scene_datetime' THEN n_scene ELSE 0 END AS c FROM n CROSS JOIN {COLUMN_LIST})"""),
    "val_empty_rows": on_trips("""
        SELECT ym AS file_month, count(*) AS rows, count(*) FILTER (WHERE ts IS NULL AND req IS NULL AND pu IS NULL) AS empty_rows
        FROM trips GROUP BY ym"""),
    "val_duplicate_rows": on_trips(REPEATS, "SELECT ym AS file_month, total AS rows, duplicate_rows FROM repeats"),
    "val_gate": on_trips(REPEATS, """
        SELECT ym AS file_month, check_name, CASE WHEN check_name = 'duplicate_rows' THEN duplicate_rows ELSE 0 END AS rows_affected,
          CASE WHEN check_name = 'duplicate_rows' AND duplicate_rows > 0 THEN 'warn' ELSE 'pass' END AS verdict
        FROM repeats CROSS JOIN (VALUES ('unexpected_nulls'), ('empty_rows'), ('duplicate_rows')) AS k(check_name)"""),
    "val_month_membership": on_trips("""
        SELECT ym AS file_month, count(*) AS rows, count(*) FILTER (WHERE year(ts)*100 + month(ts) <> ym) AS foreign_rows
        FROM trips GROUP BY ym"""),
    "qc_partition": on_trips(QC_CTE, QC_SELECT),
    "ods_count_checks": on_trips(ODS_CTE, f"""
        SELECT check_group, check_name, severity, {ODS_LIST}[i] AS rows_affected,
          {rate(f'100 * {ODS_LIST}[i]', 'total', 6)} AS share_pct FROM counted CROSS JOIN {ODS_NAMES}"""),
    "ods_max_checks": on_trips(f"m AS (SELECT {MAX_LIST} AS v FROM trips)", """
        SELECT 'maxima' AS check_group, concat('max(', name, ')') AS check_name, CAST(0 AS BIGINT) AS rows_affected,
          CAST(0 AS DOUBLE) AS share_pct, 'info' AS severity,
          regexp_replace(concat(v[i] // 1000, '.', lpad(CAST(v[i] % 1000 AS VARCHAR), 3, '0')), '\\.?0+$', '') AS note
        FROM m CROSS JOIN """ + _rows([f"({i + 1}, '{n}')" for i, n in enumerate(MAXIMA)], "i, name")),
    "ods_gate": on_trips(ODS_CTE, f"""
        SELECT count(*) AS checks, {hits('n > 0')} AS checks_hit, {hits("n > 0 AND severity = 'error'")} AS errors,
          {hits("n > 0 AND severity = 'warning'")} AS warnings, {hits("n > 0 AND severity = 'error'")} = 0 AS build_allowed
        FROM (SELECT severity, {ODS_LIST}[i] AS n FROM counted CROSS JOIN {ODS_NAMES})"""),
    "src_discover_months": on_trips("""
        SELECT DISTINCT ym AS month, CASE WHEN ym % 2 = 0 THEN 'parquet' ELSE 'csv' END AS format FROM trips"""),
    "src_parquet_trips": on_trips(f"""
        SELECT ym AS month, count(*) AS trips, {hits('shr')} AS shared_request_flag, {hits('shm')} AS shared_match_flag,
          {hits('aar')} AS access_a_ride_flag, {hits('wvr')} AS wav_request_flag, {hits('wvm')} AS wav_match_flag,
          {usd('sum(base)')} AS sum_base_fare, count(scene) AS on_scene_known, count(originating) AS originating_known
        FROM trips GROUP BY ym"""),
    "src_csv_to_parquet": on_trips("""
        SELECT ym AS file_month, count(*) AS rows, min(ts) AS first_pickup, max(drp) AS last_dropoff, 'parquet' AS format
        FROM trips GROUP BY ym"""),
    "src_zone_lookup": on_silver_zones("""
        SELECT location_id, borough, zone, service_zone, coalesce(n, 0) AS trips
        FROM zones LEFT JOIN (SELECT pu, count(*) AS n FROM trips GROUP BY pu) ON pu = location_id"""),
    "src_partition_summary": on_trips("SELECT ym AS pickup_month, count(*) AS rows FROM trips GROUP BY ym"),
    "sink_month_partition": on_trips("""
        SELECT ym AS file_month, count(*) AS expected,
          CASE ym % 3 WHEN 0 THEN count(*) WHEN 1 THEN count(*) FILTER (WHERE pu > 100) ELSE 0 END AS existing,
          CASE ym % 3 WHEN 0 THEN 'skipped' WHEN 1 THEN 'replaced' ELSE 'loaded' END AS status, count(*) AS rows
        FROM trips GROUP BY ym"""),
    "sink_replace_mart": f"SELECT *, CAST(2 AS INTEGER) AS version FROM ({MART_SQL['mart_overview_daily']})",
    "sink_csv_export": HISTOGRAM_LINES,
    "sink_load_log": on_trips("""
        SELECT concat('fhvhv_tripdata_', ym // 100, '-', lpad(CAST(ym % 100 AS VARCHAR), 2, '0'), '.parquet') AS file_name,
          CAST(ym AS VARCHAR) AS partition_id, n AS rows_loaded, status, message
        FROM (SELECT ym, count(*) AS n FROM trips GROUP BY ym)
        CROSS JOIN (VALUES ('loaded', 'rows before: 0'), ('skipped', 'already complete')) AS k(status, message)"""),
    "sink_replace_rows": on_trips(QC_CTE, REPEATS, QC_SELECT + f"""
        UNION ALL SELECT ym, 'empty rows (все поля NULL)', 0, 0, 'excluded' FROM repeats
        UNION ALL SELECT ym, 'full duplicate rows', duplicate_rows, {pct('duplicate_rows', 'total')}, 'flagged' FROM repeats"""),
    "stream_month_ingest": on_trips("SELECT ym AS pickup_month, count(*) AS trips FROM trips GROUP BY ym"),
}
SQL |= {f"{name}_flawed": flawed(SQL[name]) for name in ("qc_partition", "ods_count_checks", "ods_gate")} | {
    "val_null_profile_flawed": on_trips(FILES, f"""
        SELECT ym AS file_month, column_name, c AS null_count, {pct('c', 'rows')} AS null_pct,
          c = 0 OR column_name IN ('originating_base_num', 'on_scene_datetime') AS expected
        FROM (SELECT ym, rows, column_name, CASE column_name WHEN 'originating_base_num' THEN originating
                WHEN 'on_scene_datetime' THEN scene WHEN 'tips' THEN empty + tips ELSE empty END AS c FROM n CROSS JOIN {COLUMN_LIST})"""),
    "val_gate_flawed": on_trips(FILES, """
        SELECT ym AS file_month, check_name, affected AS rows_affected,
          CASE WHEN affected = 0 THEN 'pass' WHEN check_name = 'duplicate_rows' THEN 'warn' ELSE 'fail' END AS verdict
        FROM (SELECT ym, check_name, CASE check_name WHEN 'unexpected_nulls' THEN 23 * empty + tips WHEN 'empty_rows' THEN empty
                ELSE copies END AS affected
              FROM n CROSS JOIN (VALUES ('unexpected_nulls'), ('empty_rows'), ('duplicate_rows')) AS k(check_name))"""),
    "val_month_membership_flawed": on_trips(FILES, "SELECT ym AS file_month, rows, foreign_rows FROM n"),
}
