"""Array expressions that Spark has no single function for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 64


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def before(sizes: Column) -> Column:
    """Exclusive running sums, over blocks so that long arrays stay cheap."""
    last = F.floor((F.size(sizes) - 1) / BLOCK).cast("int")
    in_blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(sizes, b * BLOCK + 1, BLOCK))

    def inside(block: Column, sums: Column, b: Column) -> Column:
        return let(
            total(F.slice(sums, F.lit(1), b)),
            lambda start: F.transform(block, lambda _, i: start + total(F.slice(block, F.lit(1), i))),
        )

    return let(
        in_blocks,
        lambda blocks: let(
            F.transform(blocks, total),
            lambda sums: F.flatten(F.transform(blocks, lambda block, b: inside(block, sums, b))),
        ),
    )
