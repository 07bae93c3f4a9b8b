"""Exact arithmetic on measured amounts.

Money is published to the cent and distance to a thousandth of a mile. Summing
them as whole cents and thousandths makes every sum exact and independent of
the order in which partitions arrive, so a re-run after an executor loss gives
the same digits. Ratios of such sums are rounded half to even on integers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS = 100
MILLI = 1000
_WIDE = "DECIMAL(38,0)"


def cents(money: Column | str) -> Column:
    return F.rint(_col(money) * 100.0).cast("bigint")


def milli(miles: Column | str) -> Column:
    return F.rint(_col(miles) * 1000.0).cast("bigint")


def ratio(num: str, den: str, digits: int, *, times: int = 1, unit: int = 1) -> Column:
    """``num * times / (den * unit)`` rounded to ``digits`` as a double; NULL when den is 0.

    ``num`` and ``den`` are SQL over integer sums. ``unit`` is the scale of
    ``num`` (100 for cents, 1000 for thousandths of a mile, 60 for seconds).
    """
    top = f"(CAST(abs({num}) AS {_WIDE}) * {10**digits * times})"
    low = f"(nullif(CAST({den} AS {_WIDE}), 0) * {unit})"
    whole = f"({top} div {low})"
    twice = f"(({top} - CAST({whole} AS {_WIDE}) * {low}) * 2)"
    up = f"CASE WHEN {twice} > {low} OR ({twice} = {low} AND {whole} % 2 = 1) THEN 1 ELSE 0 END"
    return F.expr(f"CAST(sign({num}) * ({whole} + {up}) AS DOUBLE) / {10**digits}D")


def dollars(sum_cents: Column | str) -> Column:
    """A sum of cents as dollars."""
    return _col(sum_cents).cast("double") / 100.0


def miles(sum_milli: str) -> Column:
    """A sum of thousandths of a mile as miles, rounded to two digits."""
    return ratio(sum_milli, "1", 2, unit=MILLI)


def plain_number(x: Column | str) -> Column:
    """Every digit of a number as decimal text, without exponent or trailing zeros.

    Numbers beyond what 38 digits can write, and those that are none, keep
    their own text.
    """
    value = _col(x)
    text = value.cast("string")
    size = F.abs(value.cast("double"))
    large, small = (value.try_cast(f"decimal(38,{n})").cast("string") for n in (9, 37))
    wide = F.coalesce(F.when(size >= 1, large).otherwise(small), text)
    text = F.when(text.contains("E"), wide).otherwise(text)
    return F.when(text.contains(".") & ~text.contains("E"), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x
