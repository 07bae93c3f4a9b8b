"""Grouped sums with exact quantiles, in two steps that survive hot groups.

Step one groups by the keys *and* the value whose quantiles are wanted, which
partial aggregation shrinks on the map side; a group that holds a third of all
rows is spread over its distinct values. Step two sees at most one row per
(group, value), with counts as frequencies. Values are bounded (whole seconds
up to two hours, or cents), so no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS = "n"


def fold(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], spread: str
) -> DataFrame:
    """One row per (keys, spread value): ``n`` and the partial sums."""
    return df.groupBy(*keys, spread).agg(
        F.count(F.lit(1)).alias(ROWS), *[F.sum(F.expr(v)).alias(k) for k, v in sums.items()]
    )


def unfold(
    folded: DataFrame, keys: Sequence[str], sums: Sequence[str], spread: str,
    quantiles: Mapping[str, float], of_spread: Mapping[str, str] | None = None,
) -> DataFrame:
    """Group totals from :func:`fold` output; NULL quantiles for empty groups.

    ``of_spread`` are sums that follow from the folded value and its count
    alone, so the fold does not have to carry them.
    """
    totals = [
        F.sum(ROWS).alias("trips"), *[F.sum(k).alias(k) for k in sums],
        *[F.sum(F.expr(v)).alias(k) for k, v in (of_spread or {}).items()],
    ]
    return with_quantiles(folded, keys, totals, spread, quantiles)


def with_quantiles(
    folded: DataFrame, keys: Sequence[str], others: Sequence[Column], value: str,
    quantiles: Mapping[str, float],
) -> DataFrame:
    """Aggregates ``others`` and exact interpolated quantiles of folded rows.

    The value at rank r is the least one whose running count exceeds r. Only
    sorting and summing is needed, so nothing is held in memory per group; the
    aggregate reuses the partitioning of the window.
    """
    group = Window.partitionBy(*keys)
    known = F.when(F.col(value).isNotNull(), F.col(ROWS))
    ranked = folded.select(
        "*", F.sum(known).over(group.orderBy(value)).alias("_upto"), F.sum(known).over(group).alias("_all")
    )
    bounds = []
    for name, q in quantiles.items():
        for side in ("floor", "ceil"):
            bounds.append(F.expr(
                f"min(CASE WHEN _upto > {side}((_all - 1) * {q}D) THEN {value} END)"
            ).alias(f"_{name}_{side}"))
    grouped = ranked.groupBy(*keys).agg(*others, F.max("_all").alias("_all"), *bounds)
    rest = [x for x in grouped.columns if not x.startswith("_")]
    return grouped.select(*rest, *[
        F.expr(f"_{n}_floor + (_{n}_ceil - _{n}_floor) * ((_all - 1) * {q}D % 1)").alias(n)
        for n, q in quantiles.items()
    ])


def rows_where(cond: str) -> str:
    """SQL of the rows a folded row stands for, if ``cond`` holds for it."""
    return f"CASE WHEN {cond} THEN {ROWS} ELSE 0L END"


def tally(cond: str) -> str:
    """SQL of 1 where true, else 0: sums to a count."""
    return f"CASE WHEN {cond} THEN 1L ELSE 0L END"
