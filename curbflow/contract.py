"""The trip record contract: 25 columns, their types, and which may be NULL.

Two schemas describe the same columns. ``SOURCE_SCHEMA`` is what month files
hold (flags as text), ``TRIP_SCHEMA`` is the bronze table (flags as booleans).
Times are naive local times, so they are TIMESTAMP_NTZ throughout: a zoned
timestamp would move rows that fall into a daylight-saving gap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT, _TIME, _ID = T.StringType(), T.TimestampNTZType(), T.IntegerType()
_WHOLE, _AMOUNT = T.LongType(), T.DoubleType()

# Column order and types of the published trip files.
SOURCE_SCHEMA = (
    T.StructType()
    .add("hvfhs_license_num", _TEXT)
    .add("dispatching_base_num", _TEXT)
    .add("originating_base_num", _TEXT)
    .add("request_datetime", _TIME)
    .add("on_scene_datetime", _TIME)
    .add("pickup_datetime", _TIME)
    .add("dropoff_datetime", _TIME)
    .add("PULocationID", _ID)
    .add("DOLocationID", _ID)
    .add("trip_miles", _AMOUNT)
    .add("trip_time", _WHOLE)
    .add("base_passenger_fare", _AMOUNT)
    .add("tolls", _AMOUNT)
    .add("bcf", _AMOUNT)
    .add("sales_tax", _AMOUNT)
    .add("congestion_surcharge", _AMOUNT)
    .add("airport_fee", _AMOUNT)
    .add("tips", _AMOUNT)
    .add("driver_pay", _AMOUNT)
    .add("shared_request_flag", _TEXT)
    .add("shared_match_flag", _TEXT)
    .add("access_a_ride_flag", _TEXT)
    .add("wav_request_flag", _TEXT)
    .add("wav_match_flag", _TEXT)
    .add("cbd_congestion_fee", _AMOUNT)
)

COLUMNS = SOURCE_SCHEMA.fieldNames()
FLAGS = [c for c in COLUMNS if c.endswith("_flag")]
MAY_BE_NULL = frozenset({"originating_base_num", "on_scene_datetime"})

TRIP_SCHEMA = T.StructType(
    [
        T.StructField(
            f.name,
            T.BooleanType() if f.name in FLAGS else f.dataType,
            f.name in MAY_BE_NULL,
        )
        for f in SOURCE_SCHEMA.fields
    ]
)

# Fixed value: the only flag text that counts as true.
FLAG_TRUE = "Y"

PARTITION = "pickup_month"


def month_key(ts: Column) -> Column:
    """yyyyMM of a timestamp as an integer: the bronze partition value."""
    return F.year(ts) * 100 + F.month(ts)


def to_bronze(source: DataFrame, *beside: str) -> DataFrame:
    """Contract columns in contract order, flags as booleans, and the columns ``beside`` as they are.

    Columns are taken by name, so the order in the file does not matter. A
    NULL flag stays NULL here; the null gate decides about it before loading.
    """
    return source.select(
        *[
            (F.col(c) == FLAG_TRUE).alias(c) if c in FLAGS
            else F.col(c).cast(SOURCE_SCHEMA[c].dataType).alias(c)
            for c in COLUMNS
        ],
        *beside,
    )


class ContractError(RuntimeError):
    """Columns or types do not follow the contract."""


def compare_columns(actual: list[str]) -> list[tuple[str, str, int | None, int | None]]:
    """(column, status, expected position, actual position); status is
    ok, moved (present, other position), missing or extra."""
    want = {name: i for i, name in enumerate(COLUMNS)}
    have = {name: i for i, name in enumerate(actual)}
    out = []
    for name in [*COLUMNS, *(n for n in actual if n not in want)]:
        expected, found = want.get(name), have.get(name)
        if found is None:
            status = "missing"
        elif expected is None:
            status = "extra"
        else:
            status = "ok" if expected == found else "moved"
        out.append((name, status, expected, found))
    return out


def require_columns(actual: list[str], name: str = "") -> bool:
    """Raise on missing or extra columns; report whether the order matches."""
    rows = compare_columns(actual)
    wrong = {s: sorted(r[0] for r in rows if r[1] == s) for s in ("missing", "extra")}
    if any(wrong.values()):
        detail = "; ".join(f"{s}: {', '.join(c)}" for s, c in wrong.items() if c)
        raise ContractError(f"{name}: {detail}")
    return all(r[1] == "ok" for r in rows)
