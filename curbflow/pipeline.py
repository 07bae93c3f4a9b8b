"""The whole batch: month files to bronze, checks, gold tables, CSV.

    python -m curbflow.pipeline load   --files DIR --zones CSV --warehouse DIR [--force] [--migrate]
    python -m curbflow.pipeline export --warehouse DIR --out DIR [--sep ';'] [--with-quality]

All months go through each step together; only per-month summaries reach the
driver.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.contract import PARTITION
from curbflow.operators import contract_checks, profile, quality
from curbflow.plans import marts
from curbflow.sinks import bronze, csv_export, gold, service, snapshots
from curbflow.sources import months
from curbflow.sources import zones as zone_source

c = F.col
QUALITY_TABLES = ["zones", "ods_checks", "etl_load_log", "etl_anomalies", "etl_column_profile"]


def _replace(spark: SparkSession, warehouse: str, name: str, fresh: DataFrame, keys: list[str]) -> None:
    """Publish a service table with the rows of ``fresh`` in place of equal keys."""
    if gold.versions(spark, warehouse, name):
        fresh = service.replace_rows(gold.current(spark, warehouse, name), fresh, keys)
    gold.publish(fresh, warehouse, name)


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("checked_at", F.current_timestamp())


def load(
    spark: SparkSession, files: str, zone_csv: str, warehouse: str, *,
    force: bool = False, migrate: bool = False,
) -> dict[str, int]:
    """Run everything; returns the version of every mart. May be repeated at will."""
    table = f"{warehouse}/trips"
    rebuild = False
    if snapshots.current(spark, table):
        stored = bronze.read(spark, table).drop(PARTITION).schema
        rebuild = not contract_checks.require_types(stored, migrate)

    months.csv_to_parquet(spark, files)
    source = months.read(spark, files)

    checks = f"{warehouse}/_checks/{uuid.uuid4().hex[:10]}"
    seen = months.inspect(spark, files, f"{checks}/footers")
    # only months that will be written need profiling
    plan = bronze.load_plan(
        bronze.folder_counts(spark, seen), bronze.month_counts(spark, table), force or rebuild
    )
    todo = [r.file_month for r in plan.where("status <> 'skipped'").collect()]
    counts = None
    if todo:
        pending = source.where(c("file_month").isin(todo))
        counts = profile.assessed(pending, checks, seen).where(c("file_month").isin(todo))
        _replace(spark, warehouse, "etl_column_profile",
                 _stamped(profile.null_profile(counts)), ["file_month", "column_name"])
        found = profile.source_anomalies(counts).withColumnRenamed("file_month", "partition_id")
        _replace(spark, warehouse, "etl_anomalies", _stamped(found), ["partition_id", "metric_name"])

    result = bronze.load(spark, source, table, force, rebuild, counts, seen)
    service.append_log(service.log_entries(result), f"{warehouse}/etl_load_log")
    trips = bronze.read(spark, table)
    if todo:
        changed = trips.where(c(PARTITION).isin(todo))
        _replace(spark, warehouse, "etl_anomalies",
                 _stamped(quality.partition_anomalies(changed)), ["partition_id", "metric_name"])

    gold.publish(_stamped(quality.all_checks(trips)), warehouse, "ods_checks")
    quality.require(gold.current(spark, warehouse, "ods_checks"))

    gold.publish(zone_source.read_lookup(spark, zone_csv).coalesce(1), warehouse, "zones")
    built = gold.refresh(spark, table, gold.current(spark, warehouse, "zones"), f"{warehouse}/gold")
    for month in bronze.month_counts(spark, table).orderBy(PARTITION).collect():  # a row per month
        print(month[PARTITION], month.existing)
    return built


def export(
    spark: SparkSession, warehouse: str, out: str, sep: str = ",", with_quality: bool = False,
    single: bool = False,
) -> DataFrame:
    """Write every mart, and the service tables if asked, as CSV."""
    tables = {n: gold.current(spark, f"{warehouse}/gold", n) for n in marts.MARTS}
    if with_quality:
        for name in QUALITY_TABLES:
            tables[name] = (
                service.read_log(spark, f"{warehouse}/{name}") if name == "etl_load_log"
                else gold.current(spark, warehouse, name)
            )
    return csv_export.export_summary(spark, csv_export.export_all(tables, out, sep, single), out)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    loading = commands.add_parser("load")
    for name in ("files", "zones", "warehouse"):
        loading.add_argument(f"--{name}", required=True)
    loading.add_argument("--force", action="store_true", help="reload complete months too")
    loading.add_argument("--migrate", action="store_true", help="rebuild a table of other types")
    exporting = commands.add_parser("export")
    exporting.add_argument("--warehouse", required=True)
    exporting.add_argument("--out", required=True)
    exporting.add_argument("--sep", default=",")
    exporting.add_argument("--with-quality", action="store_true")
    exporting.add_argument("--single-file", action="store_true", help="one file per table")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("curbflow").getOrCreate()
    if args.command == "load":
        load(spark, args.files, args.zones, args.warehouse, force=args.force, migrate=args.migrate)
    else:
        summary = export(spark, args.warehouse, args.out, args.sep, args.with_quality, args.single_file)
        for row in summary.collect():  # a row per table
            print(*row)


if __name__ == "__main__":
    main()
