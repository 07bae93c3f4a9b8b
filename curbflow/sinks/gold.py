"""Publishing gold tables so that readers never see a half-built one, and rebuilding only what changed.

Every table is a snapshot (see ``snapshots``): a build is written aside and committed whole, and of two
builds that start from the same version one is refused. Marts are stored by the month of their first key. Each
mart's manifest keeps a ledger, the bronze folder of every month it was built from; months whose folder is
another one now are the only ones computed again.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.contract import PARTITION, month_key
from curbflow.functions import trip as t
from curbflow.plans import marts, rollups
from curbflow.sinks import bronze, snapshots

MARKER = "_SUCCESS"
#: Folder column of tables that are stored by month.
MONTH = "gold_month"


def _older(spark: SparkSession, root: str, name: str) -> tuple[list[int], list[int]]:
    """Numbers of the folders of the layout without manifests: all of them, and the finished ones."""
    labels = snapshots._names(spark, f"{root}/{name}")
    taken = sorted(int(n[1:]) for n in labels if re.fullmatch("v[0-9]+", n))
    return taken, [v for v in taken if MARKER in snapshots._names(spark, f"{root}/{name}/v{v}")]


def versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Committed versions of a table, oldest first."""
    return sorted(set(_older(spark, root, name)[1]) | set(snapshots.versions(spark, f"{root}/{name}")))


def publish(
    df: DataFrame, root: str, name: str, sort_key: str | None = None, by_month: str | None = None,
    months: list[int] | None = None, note: dict | None = None,
) -> int:
    """Write ``df`` as the next version of ``name``; returns the version.

    ``by_month`` is the date column whose month places a row; ``months`` are then the only ones replaced, and
    those of them without rows go. A version that someone else committed meanwhile stops this one, unless it
    changed other months.
    """
    spark, path = df.sparkSession, f"{root}/{name}"
    base = snapshots.current(spark, path)
    rows = df.withColumn(MONTH, month_key(F.col(by_month))) if by_month else df
    # rows of a month that is not replaced would be lost by the commit, so they are none
    rows = rows.where(F.col(MONTH).isin(months)) if by_month and months is not None else rows
    order = [*([MONTH] if by_month else []), *([sort_key] if sort_key else [])]
    parts = snapshots.stage(rows.sortWithinPartitions(*order) if order else rows, path, MONTH if by_month else None)
    partial = by_month is not None and months is not None and base is not None
    done = snapshots.commit(
        spark, path, base, parts, df.schema, MONTH if by_month else None, everything=not partial,
        removed={str(m) for m in months} if partial else None, note=note,
        least=max(_older(spark, root, name)[0], default=0) + 1,
    )
    return done.version


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    if snapshots.versions(spark, f"{root}/{name}"):
        return snapshots.read(spark, f"{root}/{name}", keep_by=False)
    done = _older(spark, root, name)[1]
    if not done:
        raise FileNotFoundError(f"no committed version of {name} below {root}")
    return spark.read.parquet(f"{root}/{name}/v{done[-1]}")


def build_all(
    trips: DataFrame, zones: DataFrame, root: str, months: list[int] | None = None, note: dict | None = None
) -> dict[str, int]:
    """Rebuild all marts, or only ``months`` of them. Marts of one grain share a stored aggregate.

    The shared aggregate is itself published and read back, so a lost
    executor never costs more than the mart being written.
    """
    spark = trips.sparkSession
    if months is not None and PARTITION in trips.columns:
        trips = trips.where(F.col(PARTITION).isin(months))
    built: dict[str, int] = {}

    def put(df: DataFrame, name: str) -> None:
        key = mart_sort_key(name)
        built[name] = publish(df, root, name, key, by_month=key, months=months, note=note)

    for grain, (base, names) in marts.shared_bases(trips).items():
        publish(base, root, f"_base_{grain}")
        stored = current(spark, root, f"_base_{grain}")
        for name in names:
            put(marts.MARTS[name].finish(stored, zones), name)
        snapshots.expire(spark, f"{root}/_base_{grain}")
    for name in marts.MARTS:
        if name not in built:
            put(marts.build(name, trips, zones), name)
    for name in _states():
        publish_state(name, trips, root, months)
    return built


def _states() -> list[str]:
    return [n for n in rollups.STATES if n in marts.MARTS]


def publish_state(name: str, trips: DataFrame, root: str, months: list[int] | None = None) -> int:
    """Keep the mergeable waiting state of a mart beside it, by the same months."""
    key = rollups.STATES[name][0][0]
    return publish(rollups.mart_state(name, t.measures(trips)), root, f"_state_{name}", key, by_month=key, months=months)


def state(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The stored waiting state of a mart."""
    return current(spark, root, f"_state_{name}")


def ledger(spark: SparkSession, table: str) -> dict[str, str]:
    """The folder of every month of a bronze table."""
    now = snapshots.current(spark, table)
    return {month: part.folder for month, part in now.parts.items()} if now else {}


def changed_months(spark: SparkSession, table: str, root: str, zones: str) -> list[int] | None:
    """Months of the bronze table that some mart was not built from, or that it was and are gone; None for all.

    ``zones`` names the zone lookup's content: with another one, names and segments of every month are old.
    """
    now = ledger(spark, table)
    if any(snapshots.current(spark, f"{root}/_state_{name}") is None for name in _states()):
        return None
    stale: set[str] = set()
    for name in marts.MARTS:
        mart = snapshots.current(spark, f"{root}/{name}")
        if mart is None or mart.note.get("zones") != zones:
            return None
        then = mart.note.get("months", {})
        stale |= {m for m in now.keys() | then.keys() if now.get(m) != then.get(m)}
    return sorted(map(int, stale))


def refresh(spark: SparkSession, table: str, zones: DataFrame, root: str) -> dict[str, int]:
    """Bring all marts in line with the bronze table; only months that changed are computed.

    Every mart gets a new version, also where no month changed: it names the same folders then.
    """
    text = [str(r) for r in sorted(zones.collect())]  # the lookup: a few hundred rows
    name = hashlib.sha256("\n".join(text).encode()).hexdigest()
    months = changed_months(spark, table, root, name)
    return build_all(bronze.read(spark, table), zones, root, months, {"months": ledger(spark, table), "zones": name})


def expire(spark: SparkSession, root: str, keep: int = 1, grace_seconds: float = 86_400) -> None:
    """Remove all but the newest versions of every mart."""
    for name in [*marts.MARTS, *(f"_state_{n}" for n in _states())]:
        snapshots.expire(spark, f"{root}/{name}", keep, grace_seconds)


def mart_sort_key(name: str) -> str:
    """Stored rows are sorted by the first key of their mart."""
    return marts.MARTS[name].keys[0]
