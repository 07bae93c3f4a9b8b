"""Interaction audit of document filters: what every order removes at every step.

Each document is reduced to the set of filters it fails. Counts per (part, set)
are all that is kept of the documents: at most 2^5 numbers for a part, whatever its
size. The states of the subset lattice are the sets of filters applied so far; an
edge adds one filter, and what it removes is the difference of the documents that
pass its two ends. Forward counting gives the number of orders that reach a state,
backward counting the number that leave it, and an edge counts for a filter's
Shapley value as often as orders run along it. The steps of every order are read
from the same edges.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import stored
from curbflow.llm.pieces import word_lists

FILTERS = "ABCDE"
#: The first four filters: least words, least share of distinct words and largest of capitals in percent, marks.
LEAST_WORDS, DISTINCT, CAPITALS, MARKS = 50, 65, 5, re.compile(rb"[#$%&*|]")
#: The filter that fails a document whose text stands under a smaller id.
COPY = 1 << FILTERS.index("E")
STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))


def _own_failures(text: bytes) -> int:
    """The filters a text fails by itself, as bits."""
    n_words, distinct = 0, set()
    for words in word_lists(text):
        n_words += len(words)
        distinct.update(words)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    failed = (
        n_words < LEAST_WORDS,
        100 * len(distinct) < DISTINCT * n_words,
        100 * capitals > CAPITALS * len(text.decode()),
        MARKS.search(text) is not None,
    )
    return sum(1 << k for k, fails in enumerate(failed) if fails)


def _facts(texts: pd.Series) -> pd.DataFrame:
    """Own failures and SHA-256 of each text."""
    return pd.DataFrame(
        {"failed": [_own_failures(t) for t in texts], "digest": [hashlib.sha256(t).digest() for t in texts]}
    )


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, part, failed, good, toxic`` per row of ``docs (doc_id, text, source)``; ``failed`` has a bit per filter.

    Texts are taken whole, nulls as empty; a null source is the empty part. A row fails
    E if a smaller id has its text. Rows that repeat an id with its text stand or fall
    together, and rows without an id come after all others: they fail E if any id has
    their text, else they pass. Several labels of a document count if any of them says
    so; other columns of either table are not looked at. Empty tables give no rows.

    Only digests are shuffled. A text's smallest id is found by a sum with map-side
    combining, and rows meet it by digest *and* id, so that copies spread over tasks.
    """
    facts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.pandas_udf(_facts, "failed int, digest binary")(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("facts"),
    )
    rows = stored(facts.select("doc_id", "part", "facts.*"), "failures")
    least = rows.groupBy(F.col("digest").alias("_digest")).agg(F.min("doc_id").alias("_least"), F.lit(False).alias("_copy"))
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("_labelled")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    return (
        rows.join(least, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_least")), "left")
        .join(marked, F.col("doc_id") == F.col("_labelled"), "left")
        .select(
            "doc_id",
            "part",
            F.when(F.coalesce("_copy", F.lit(True)), F.col("failed").bitwiseOR(COPY)).otherwise(F.col("failed")).alias("failed"),
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
        )
    )


def _paths(n: int) -> tuple[list[int], list[int]]:
    """Orders that reach each state from the empty set, and that leave it for the full one."""
    states = 1 << n
    reach, leave = [0] * states, [0] * states
    reach[0] = leave[-1] = 1
    for s in range(states):  # a state's number exceeds those of its subsets
        for f in range(n):
            if not s >> f & 1:
                reach[s | 1 << f] += reach[s]
    for s in reversed(range(states)):
        for f in range(n):
            if not s >> f & 1:
                leave[s] += leave[s | 1 << f]
    return reach, leave


def _passing(counts: np.ndarray, n: int) -> np.ndarray:
    """Per state, the documents that fail none of its filters; ``counts`` are by failed set."""
    passing = counts[::-1].copy()  # by the complement: the filters a document passes
    for f in range(n):
        shaped = passing.reshape(-1, 2, 1 << f)
        shaped[:, 0] += shaped[:, 1]
    return passing


def _steps(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n = len(FILTERS)
    reach, leave = _paths(n)
    orders = list(itertools.permutations(range(n)))
    for batch in rows:
        out = []
        for part, sets in zip(batch["part"], batch["sets"]):
            counts = np.zeros((3, 1 << n), dtype=np.int64)
            for s in sets:
                counts[:, s["failed"]] += [s["n"], s["n"] * s["good"], s["n"] * s["toxic"]]
            everything, good, toxic = (_passing(c, n) for c in counts)
            edge = {(s, f): (s, s | 1 << f) for s in range(1 << n) for f in range(n) if not s >> f & 1}
            shapley = [0] * n
            for (s, f), (a, b) in edge.items():
                shapley[f] += reach[a] * leave[b] * int(everything[a] - everything[b])
            for order in orders:
                s, name = 0, "".join(FILTERS[f] for f in order)
                for step, f in enumerate(order, 1):
                    a, b = edge[s, f]
                    removed, alone = everything[a] - everything[b], edge[0, f]
                    out.append((
                        part, name, step, everything[b], removed, everything[alone[0]] - everything[alone[1]] - removed,
                        counts[0, 1 << f], good[a] - good[b], toxic[a] - toxic[b], shapley[f],
                    ))
                    s = b
        yield pd.DataFrame(out, columns=[c.split()[0] for c in STEPS.split(", ")])


def interactions(failed: DataFrame) -> DataFrame:
    """Per part, order and step of the filters what the step does, from :func:`failures`.

    ``kept`` after the step, ``removed`` by it, ``redundant`` (failing its filter, removed
    earlier), ``unique_fails`` (failing no other filter), ``good_lost`` and ``toxic_lost``
    among the removed, and ``shapley``: what the filter removes, summed over all orders.
    Every part of the input has all its orders and steps, zeros included; no rows give none.
    A part is at most 128 counts before anything meets in one task.
    """
    counts = failed.groupBy("part", "failed", "good", "toxic").agg(F.count("*").alias("n"))
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("failed", "good", "toxic", "n")).alias("sets"))
    return parts.mapInPandas(_steps, STEPS)
