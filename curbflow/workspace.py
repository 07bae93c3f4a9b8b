"""Stored tables that a set of queries over one data folder shares.

The bronze table and the month files are written once per application into
the shared folder, by the same writers a real load uses; queries then read
pruned columns of a real parquet table instead of re-deriving it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from curbflow.session import digest, exists, folder
from curbflow.sinks import bronze
from curbflow.sources import derived, months
from curbflow.sources import zones as zone_source

_written: dict[str, str] = {}


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = folder(spark, digest(sf_dir))

    def once(self, name: str, write) -> str:
        key = f"{self.root}/{name}"
        path = _written.get(key)
        if path is None or not exists(self.spark, path):
            # a folder of its own, remembered only when the write returned:
            # what a failed attempt left behind is never read or added to
            path = self.scratch(name)
            write(path)
            _written[key] = path
        return path

    def trips(self) -> DataFrame:
        """Bronze trips with the partition column."""
        return bronze.read(self.spark, self.bronze())

    def bronze(self) -> str:
        """Folder of the bronze table."""
        return self.once("bronze", self._write_bronze)

    def _write_bronze(self, path: str) -> None:
        bronze.write_months(derived.seeds(self.spark, self.sf_dir), path, scattered=True, made=derived.bronze)

    def zones(self) -> DataFrame:
        path = self.once(
            "zones", lambda p: zone_source.replace(derived.zones(self.spark, self.sf_dir), p)
        )
        return self.spark.read.parquet(path)

    def offers(self) -> DataFrame:
        """Bonus offers, a stored table."""
        path = self.once("offers", lambda p: derived.offers(self.spark, self.sf_dir).write.parquet(p))
        return self.spark.read.parquet(path)

    def source(self) -> DataFrame:
        """Month-file rows with ``file_month``, not yet written anywhere."""
        return derived.month_rows(self.seeds())

    def seeds(self) -> DataFrame:
        """What those rows are made from, with ``file_month``."""
        return derived.with_month(derived.seeds(self.spark, self.sf_dir))

    def month_files(self, fmt: str = "parquet") -> str:
        """Folder with one entry per month."""
        return self.once(f"months-{fmt}", lambda p: months.write(self.source(), p, fmt))

    def flawed_trips(self) -> DataFrame:
        """Bronze trips with flaws that every quality check finds."""
        path = self.once("bronze-flawed", self._write_flawed)
        return bronze.read(self.spark, path)

    def _write_flawed(self, path: str) -> None:
        bronze.write_months(derived.flawed_seeds(self.spark, self.sf_dir), path, scattered=True, made=derived.flawed_bronze)

    def flawed_files(self) -> str:
        """Folder of month files with flaws that a load refuses."""
        return self.once("months-flawed", lambda p: months.write(derived.flawed_source(self.spark, self.sf_dir), p))

    def inspected(self, folder: str) -> months.Folder:
        """A folder of month files with its footers."""
        return months.inspect(self.spark, folder, self.scratch("footers"))

    def scratch(self, name: str) -> str:
        """A folder of its own for a query that writes."""
        return f"{self.root}/{name}-{uuid.uuid4().hex[:10]}"

    def stored(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows that a query uses more than once, written to a folder of its own and read back."""
        path = self.scratch(name)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def table(self, name: str) -> DataFrame:
        return derived.table(self.spark, self.sf_dir, name)
