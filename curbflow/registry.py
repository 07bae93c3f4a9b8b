"""All registered queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.contract import PARTITION
from curbflow.functions import trip as t
from curbflow.functions.fixed import cents
from curbflow.functions.grouping import fold
from curbflow.operators import contract_checks, experiments, geometry, profile, quality
from curbflow.plans import baselines, expressions, invariants, marts, rollups
from curbflow.sinks import bronze, csv_export, gold, service
from curbflow.sources import clock, derived, months
from curbflow.sources import zones as zone_source
from curbflow.streaming import ingest
from curbflow.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _register(**builders: Callable[[Workspace], DataFrame]) -> None:
    for name, build in builders.items():
        QUERIES[name] = lambda spark, sf_dir, b=build: b(Workspace(spark, sf_dir))


def _mart(name: str) -> Callable[[Workspace], DataFrame]:
    return lambda w: marts.build(name, w.trips(), w.zones())


def _rows(w: Workspace) -> DataFrame:
    return t.measures(w.trips())


_register(**{name: _mart(name) for name in marts.MARTS})

overview, hourly = _mart("mart_overview_daily"), _mart("mart_hourly_pattern")
pricing, daily = _mart("mart_pricing"), _mart("mart_shared_wav_daily")
segments, airports = _mart("mart_economics_segment"), _mart("mart_airports")
histogram = _mart("mart_wait_histogram")

_register(
    inv_segment_total=lambda w: invariants.segment_total(segments(w), _rows(w)),
    inv_histogram_total=lambda w: invariants.histogram_total(histogram(w), overview(w)),
    inv_price_components=lambda w: invariants.price_components(pricing(w)),
    inv_shared_split=lambda w: invariants.shared_split(daily(w)),
    inv_airport_share=lambda w: invariants.airport_share(airports(w), _rows(w)),
    inv_month_totals=lambda w: invariants.month_totals(airports(w), _rows(w)),
)

_register(
    reagg_ratio=lambda w: rollups.price_ratios(pricing(w)),
    reagg_bias_report=lambda w: rollups.bias_report(_rows(w), pricing(w)),
    reagg_avg_wait=lambda w: rollups.cohort_waits(daily(w)),
    reagg_quantile=lambda w: rollups.merged_quantiles(rollups.daily_wait_counts(_rows(w))),
    reagg_quantile_sketch=lambda w: rollups.sketch_ranks(
        rollups.merged_sketches(rollups.daily_wait_sketches(_rows(w))),
        rollups.daily_wait_counts(_rows(w)),
    ),
    market_share_monthly=lambda w: rollups.market_share(overview(w)),
    demand_profile=lambda w: rollups.demand_profile(hourly(w)),
    event_day_drop=lambda w: rollups.event_day_change(overview(w)),
    kpi_summary=lambda w: rollups.kpi_summary(_rows(w)),
    wait_by_borough=lambda w: rollups.wait_by_borough(_rows(w), w.zones()),
    worst_wait_slots=lambda w: rollups.worst_wait_slots(_rows(w)),
    wav_fulfilment=lambda w: rollups.wav_fulfilment(daily(w)),
    shared_funnel_monthly=lambda w: rollups.shared_funnel(daily(w)),
    orphan_by_operator=lambda w: rollups.orphans_by_operator(daily(w)),
    pay_ratio_range=lambda w: rollups.pay_ratio_range(pricing(w)),
    tip_share=lambda w: rollups.tip_shares(pricing(w)),
)


def _stored_state(w: Workspace, name: str) -> DataFrame:
    """The waiting state of a mart as gold keeps it."""
    root = w.scratch("gold")
    gold.publish_state(name, w.trips(), root)
    return gold.state(w.spark, root, name)


def _airport_ranks(w: Workspace) -> DataFrame:
    """Waits per airport over all time, from the stored state of the airport mart."""
    merged = rollups.merged_sketches(_stored_state(w, "mart_airports"), ("airport",))
    ends = marts.airport_ends(_rows(w)).where("wait IS NOT NULL")
    return rollups.ranks_of(merged, fold(ends, ["airport"], {}, "wait"), ["airport"])


_register(
    reagg_quantile_stored=lambda w: rollups.sketch_ranks(
        rollups.merged_sketches(_stored_state(w, "mart_pickup_zones")), rollups.daily_wait_counts(_rows(w))
    ),
    reagg_airport_wait=_airport_ranks,
)


def _deficit(w: Workspace) -> DataFrame:
    return baselines.deficit_zones(
        _rows(w), w.zones(), p90_over=t.VERY_LONG_WAIT_SECONDS, min_trips=1, min_months=2
    )


def _spill(w: Workspace) -> DataFrame:
    """Trips beside the deficit zones, which are used twice and found once."""
    treated = w.stored("treated", _deficit(w).selectExpr("pu_location_id AS zone_id"))
    return baselines.neighbour_trips(_rows(w), geometry.adjacency(_features(w), w.scratch("segments")), treated)


def _lasting(w: Workspace) -> DataFrame:
    names = w.zones().select(F.col("location_id").alias("pu_location_id"), "borough")
    weeks = baselines.zone_weeks(_rows(w)).join(names, "pu_location_id")
    return baselines.lasting_waits(weeks, over_seconds=720, min_trips=2, min_weeks=3)


def _features(w: Workspace) -> DataFrame:
    return derived.features(w.spark, w.sf_dir)


_register(
    tips_baseline=lambda w: baselines.tips(_rows(w)),
    roundup_simulation=lambda w: baselines.roundup(_rows(w)),
    tips_by_month=lambda w: baselines.tips_by_month(_rows(w)),
    wait_by_hour=lambda w: baselines.wait_by_hour(_rows(w)),
    busy_hour_pay=lambda w: baselines.busy_hour_pay(_rows(w)),
    pay_floor_gap=lambda w: baselines.pay_floor_gap(_rows(w)),
    scheduled_share=lambda w: baselines.scheduled_share(_rows(w)),
    zone_hour_wait=lambda w: baselines.zone_hour_wait(_rows(w)),
    deficit_window_select=_deficit,
    bonus_rate_choice=lambda w: baselines.bonus_rates(w.offers(), 60),
    bonus_response_curve=lambda w: baselines.response_curves(w.offers(), 60),
    lasting_wait_zones=_lasting,
    evening_wait_speed=lambda w: baselines.wait_and_speed(_rows(w)),
    airport_share=lambda w: baselines.airport_share(_rows(w)),
    airport_fares=lambda w: baselines.airport_fares(_rows(w)),
    airport_trip_time=lambda w: baselines.airport_trip_time(_rows(w)),
    neighbour_spill=_spill,
)

SALT = 17


def _users(w: Workspace) -> DataFrame:
    return experiments.assign(w.table("customer"), "c_custkey", SALT)


def _per_user(w: Workspace) -> DataFrame:
    return experiments.user_totals(
        _users(w), w.table("orders"), "c_custkey", "o_custkey", cents("o_totalprice")
    )


def _assigned_orders(w: Workspace) -> DataFrame:
    """Orders with their customer and arm, counted per customer and level first."""
    counts = w.table("orders").groupBy(
        "o_custkey", t.day_of_week(F.col("o_orderdate")).alias("weekday"),
        F.floor(F.col("o_totalprice") / 50000).alias("price_50k"),
    ).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(w.table("customer"), F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "arm", experiments.variant(F.col("o_custkey"), SALT)
    )


def _guard_rules(w: Workspace) -> DataFrame:
    return w.spark.createDataFrame(
        [("revenue_per_user", 1), ("orders_per_user", 2), ("active_users_pct", 5)],
        "metric STRING, max_drop_pct INT",
    )


def _zone_csv(w: Workspace) -> DataFrame:
    path = w.scratch("zone-csv")
    geometry.write_zone_csv(_features(w), path)
    return w.spark.read.schema(
        "LocationID INT, zone STRING, borough STRING, coordinates STRING"
    ).csv(path, header=True, escape='"')


_register(
    ab_assign=_users,
    switchback_assign=lambda w: experiments.switchback(_rows(w), w.zones()),
    switchback_effect=lambda w: experiments.ratio_effect(
        experiments.switchback(
            _rows(w), w.zones(), late=f"CAST(wait > {t.VERY_LONG_WAIT_SECONDS} AS BIGINT)", waited="CAST(wait IS NOT NULL AS BIGINT)"
        ), "late", "waited",
    ),
    clock_changes=lambda w: expressions.clock_changes(w.trips(), clock.transitions(w.spark)),
    itt_summary=lambda w: experiments.itt_summary(_per_user(w)),
    sample_size=lambda w: experiments.sample_size(_rows(w)),
    balance_check=lambda w: experiments.balance(_assigned_orders(w), {
        "zone": F.col("c_nationkey"),
        "weekday": F.col("weekday"),
        "price_50k": F.col("price_50k"),
        "user_type": F.col("c_mktsegment"),
    }),
    session_dedupe=lambda w: experiments.sessions(w.table("events")),
    funnel_steps=lambda w: experiments.funnel(
        w.table("events"), ["view", "click", "signup", "purchase"]
    ),
    exclude_days=lambda w: experiments.exclude_days(_rows(w), experiments.excluded_days(w.spark)),
    guardrails=lambda w: experiments.guardrails(_per_user(w), _guard_rules(w)),
)

_register(
    geo_field_resolve=lambda w: geometry.field_report(_features(w)),
    geo_swap_coords=lambda w: geometry.swap_coordinates(_features(w)),
    geo_errors=lambda w: geometry.geometry_errors(_features(w)),
    geo_explode_polygons=lambda w: geometry.explode_polygons(_features(w)),
    geo_zone_csv=_zone_csv,
)


# ── row rules, joins, union, order ───────────────────────────────────────────

_register(
    expr_operator=lambda w: expressions.operator(w.trips()),
    expr_wait=lambda w: expressions.wait(w.trips()),
    filter_silver=lambda w: expressions.silver(w.trips()),
    expr_wait_valid=lambda w: expressions.wait_valid(w.trips()),
    expr_scheduled=lambda w: expressions.scheduled(w.trips()),
    expr_duration_valid=lambda w: expressions.duration_valid(w.trips()),
    expr_total_fare=lambda w: expressions.total_fare(w.trips()),
    expr_time_parts=lambda w: expressions.time_parts(w.trips()),
    expr_segment=lambda w: expressions.segment(w.trips(), w.zones()),
    bucket_wait14=lambda w: expressions.wait_buckets(w.trips()),
    bucket_wait16=lambda w: expressions.wait_minute_buckets(w.trips()),
    bucket_miles=lambda w: expressions.mile_bins(w.trips()),
    dst_flags=lambda w: expressions.dst(w.trips()),
    expr_duration_diff=lambda w: expressions.duration_diff(w.trips()),
    expr_airport_name=lambda w: expressions.airport_names(w.trips()),
    cohort_regular=lambda w: expressions.regular_cohort(_rows(w)),
    join_zone_pickup=lambda w: expressions.by_pickup_zone(_rows(w), w.zones()),
    join_zone_both=lambda w: expressions.by_both_zones(_rows(w), w.zones()),
    join_totals=lambda w: expressions.with_totals(_rows(w)),
    union_directions=lambda w: expressions.directions(_rows(w)),
    agg_functions=lambda w: expressions.aggregate_functions(_rows(w)),
    sort_table_keys=lambda w: expressions.stored_order(w.trips()),
    read_zone_range=lambda w: expressions.zone_trips(bronze.read_zones(w.spark, w.bronze(), 120, 140)),
    sort_dims_first4=lambda w: csv_export.sorted_by_dimensions(airports(w)),
)

# ── contract, profile, quality ───────────────────────────────────────────────


def _source(w: Workspace) -> DataFrame:
    return months.read(w.spark, w.month_files())


def _drifted_months(w: Workspace) -> str:
    """Months as agreed, with tips as text and no tolls, or with short trip times and a further column."""
    def write(path: str) -> None:
        state, rows = F.col("file_month") % 3, w.source()
        months.write(rows.where(state == 0), path)
        months.write(rows.where(state == 1).withColumn("tips", F.col("tips").cast("string")).drop("tolls"), path)
        shorter = rows.where(state == 2).withColumn("trip_time", F.col("trip_time").cast("int"))
        months.write(shorter.withColumn("note", F.lit("")), path)

    return w.once("months-drifted", write)


def _counts(w: Workspace) -> DataFrame:
    return profile.assessed(_source(w), w.scratch("checks"), w.inspected(w.month_files()))


def _footers(w: Workspace) -> DataFrame:
    return profile.folder_counts(_source(w), w.inspected(w.month_files()))


def _flawed_counts(w: Workspace) -> DataFrame:
    return profile.folder_counts(months.read(w.spark, w.flawed_files()), w.inspected(w.flawed_files()))


def _duplicates(w: Workspace) -> DataFrame:
    return profile.with_duplicates(_footers(w), _source(w), w.scratch("hashes"))


_register(
    val_columns=lambda w: contract_checks.month_columns(w.spark, w.month_files()),
    val_type_drift=lambda w: contract_checks.month_types(w.spark, _drifted_months(w)),
    val_null_profile=lambda w: profile.null_profile(_footers(w)),
    val_empty_rows=lambda w: profile.empty_rows(_footers(w)),
    val_duplicate_rows=lambda w: profile.duplicate_rows(_duplicates(w)),
    val_gate=lambda w: profile.gate(_counts(w)),
    val_month_membership=lambda w: bronze.foreign_rows(_source(w)),
    val_null_profile_flawed=lambda w: profile.null_profile(_flawed_counts(w)),
    val_gate_flawed=lambda w: profile.gate(profile.assessed(months.read(w.spark, w.flawed_files()), w.scratch("checks"), w.inspected(w.flawed_files()))),
    val_month_membership_flawed=lambda w: bronze.foreign_rows(months.read(w.spark, w.flawed_files())),
    qc_partition_flawed=lambda w: quality.partition_anomalies(w.flawed_trips()),
    ods_count_checks_flawed=lambda w: quality.count_checks(w.flawed_trips()).drop("note"),
    ods_gate_flawed=lambda w: quality.verdict(quality.all_checks(w.flawed_trips())),
    qc_partition=lambda w: quality.partition_anomalies(w.trips()),
    ods_count_checks=lambda w: quality.count_checks(w.trips()).drop("note"),
    ods_max_checks=lambda w: quality.max_checks(w.trips()),
    ods_gate=lambda w: quality.verdict(quality.all_checks(w.trips())),
)

# ── sources and sinks ────────────────────────────────────────────────────────


def _mixed_months(w: Workspace) -> str:
    """Every month as CSV, even months as parquet as well."""
    def write(path: str) -> None:
        months.write(w.source(), path, "csv")
        months.write(w.source().where("file_month % 2 = 0"), path, "parquet")

    return w.once("months-mixed", write)


def _converted(w: Workspace) -> DataFrame:
    folder = w.scratch("months-csv")
    months.write(w.source(), folder, "csv")
    months.csv_to_parquet(w.spark, folder)
    counts = months.read(w.spark, folder).groupBy("file_month").agg(
        F.count(F.lit(1)).alias("rows"), F.min("pickup_datetime").alias("first_pickup"),
        F.max("dropoff_datetime").alias("last_dropoff"),
    )
    entries = months.inventory(w.spark, folder).select("month", "format")
    return counts.join(entries, F.col("file_month") == F.col("month")).drop("month")


def _lookup(w: Workspace) -> DataFrame:
    path = w.scratch("lookup")
    zone_source.write_lookup(w.zones(), path)
    used = w.trips().groupBy("PULocationID").agg(F.count(F.lit(1)).alias("trips"))
    looked_up = zone_source.read_lookup(w.spark, path)
    return looked_up.join(used, F.col("location_id") == F.col("PULocationID"), "left").select(
        *looked_up.columns, F.coalesce("trips", F.lit(0)).alias("trips")
    )


def _loaded(w: Workspace) -> DataFrame:
    """A load over a table that is complete, short or empty, month by month."""
    table = w.scratch("load")
    state = F.col("file_month") % 3
    kept = w.seeds().where((state == 0) | ((state == 1) & (F.col("PULocationID") > 100)))
    bronze.write_months(kept, table, scattered=True, made=derived.bronze)
    return bronze.load(w.spark, _source(w), table, folder=w.inspected(w.month_files())).drop("seconds")


def _published(w: Workspace) -> DataFrame:
    """A mart published twice: readers get the newer version."""
    root = w.scratch("gold")
    gold.publish(overview(w), root, "overview", "trip_date")
    gold.publish(gold.current(w.spark, root, "overview"), root, "overview", "trip_date")
    return gold.current(w.spark, root, "overview").withColumn(
        "version", F.lit(gold.versions(w.spark, root, "overview")[-1])
    )


def _exported(w: Workspace) -> DataFrame:
    out = w.scratch("export")
    csv_export.export_all({"mart_wait_histogram": histogram(w)}, out)
    return w.spark.read.text(f"{out}/mart_wait_histogram.csv")


def _logged(w: Workspace) -> DataFrame:
    """The log of a first load and of a repeated one that finds nothing to do."""
    table, log = w.scratch("load"), w.scratch("log")
    for _ in range(2):
        service.append_log(service.log_entries(bronze.load(w.spark, _source(w), table, folder=w.inspected(w.month_files()))), log)
    return service.read_log(w.spark, log).drop("loaded_at", "load_duration_sec")


def _anomalies(w: Workspace) -> DataFrame:
    """The anomaly table after a repeated check: own metrics replaced, others kept."""
    fresh = w.stored("anomalies", quality.partition_anomalies(w.trips()))  # used three times
    stale = fresh.withColumn("rows_affected", F.lit(-1).cast("bigint"))
    kept = profile.source_anomalies(_counts(w)).withColumnRenamed(
        "file_month", "partition_id"
    )
    return service.replace_rows(stale.unionByName(kept), fresh, ["partition_id", "metric_name"])


def _streamed(w: Workspace) -> DataFrame:
    """Months as they arrive in two deliveries, then a run without new files."""
    folder, table, state = w.scratch("incoming"), w.scratch("streamed"), w.scratch("offsets")
    first = F.col("file_month") < 202509
    for part in (w.source().where(first), w.source().where(~first), None):
        if part is not None:
            months.write(part, folder)
        ingest.ingest(w.spark, folder, table, state)
    return bronze.read(w.spark, table).groupBy(PARTITION).agg(F.count(F.lit(1)).alias("trips"))


_register(
    src_discover_months=lambda w: months.inventory(w.spark, _mixed_months(w)).select(
        "month", "format"
    ),
    src_parquet_trips=lambda w: expressions.bronze_by_month(_source(w)),
    src_csv_to_parquet=_converted,
    src_zone_lookup=_lookup,
    src_partition_summary=lambda w: bronze.month_counts(w.spark, w.bronze()).withColumnRenamed("existing", "rows"),
    sink_month_partition=_loaded,
    sink_replace_mart=_published,
    sink_csv_export=_exported,
    sink_load_log=_logged,
    sink_replace_rows=_anomalies,
    stream_month_ingest=_streamed,
)
