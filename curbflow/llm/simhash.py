"""Near-duplicate documents by SimHash with deletion-variant signatures.

A 64-bit fingerprint is cut into two halves. Of two fingerprints that differ in
at most three bits, one half differs in at most one, so masking one bit of that
half ("one wildcard") makes the halves equal for at least one of 32 positions.
Every distinct fingerprint is therefore indexed under 64 masked halves; equal
keys are candidates, verified by their full distance.

Copies never meet in pairs: equal fingerprints are one node. A key shared by
more fingerprints than one task should hold is refined: the open half is cut in
two again by the same argument, and so on. After two refinements eleven bits
are open, so a group has at most 2048 fingerprints whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.llm.common import fresh, session, stored
from curbflow.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
#: Fingerprints under one key that a task compares directly; larger keys are refined first.
GROUP_LIMIT = 8192
SEED = 42


def fingerprint_of(text: str | None, words_in_shingle: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of one text; zero without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < words_in_shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_in_shingle))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, words_in_shingle: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf(T.LongType())
    def batch(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, words_in_shingle) for t in texts], dtype="int64")

    return batch(text)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _variants(start: int, width: int, fixed: int = 0) -> list[tuple[int, int, int]]:
    """(mask, start, width of the part left open) for each wildcard in each half of a part."""
    half = width // 2
    out = []
    for lo, other in ((start, start + half), (start + half, start)):
        whole = ((1 << half) - 1) << lo
        out += [(fixed | whole & ~(1 << i), other, half) for i in range(lo, lo + half)]
    return out


def _keyed(rows: DataFrame, masks: Column) -> DataFrame:
    """A row for every fingerprint and mask: the mask's key, what it leaves open, the fingerprint."""
    return rows.select("fp", F.explode(masks).alias("v")).select(
        F.col("v.mask").alias("mask"),
        F.col("fp").bitwiseAND(F.col("v.mask")).alias("part"),
        F.col("v.start").alias("start"),
        F.col("v.width").alias("width"),
        "fp",
    )


def _mask_array(variants: list[tuple[int, int, int]]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(_signed(m)).cast("long").alias("mask"),
                F.lit(s).cast("int").alias("start"),
                F.lit(w).cast("int").alias("width"),
            )
            for m, s, w in variants
        ]
    )


LINKS = T.StructType(
    [
        T.StructField("a", T.LongType()),
        T.StructField("b", T.LongType()),
        T.StructField("mask", T.LongType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
    ]
)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits; of unsigned numbers, as a signed one's bits are counted without its sign."""
    return np.bitwise_count((a ^ b).view(np.uint64))


class _Forest:
    """Smallest linked fingerprint of each one seen; keeps a task's links few."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.setdefault(x, x)) != x:
            up[x] = x = up[p]
        return x

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def rows(self) -> pd.DataFrame:
        found = [(self.root(x), x) for x in list(self.up)]
        found = [x for x in found if x[0] != x[1]]
        frame = pd.DataFrame(found, columns=["a", "b"], dtype="int64")
        return frame.assign(mask=0, start=-1, width=0)


def _compare(values: np.ndarray, forest: _Forest, max_bits: int, tile: int = 1024) -> None:
    for i in range(0, len(values), tile):
        left = values[i : i + tile, None]
        for j in range(i, len(values), tile):
            near = _distance(left, values[None, j : j + tile]) <= max_bits
            x, y = np.nonzero(np.triu(near, 1) if i == j else near)
            for a, b in zip(values[x + i].tolist(), values[y + j].tolist()):
                forest.link(a, b)


def _link_groups(max_bits: int, limit: int):
    """Rows sorted by key to links; the rows of keys over the limit come back unlinked."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = _Forest()
        kept: list[pd.DataFrame] = []  # rows of the key still open
        open_key, size, over = None, 0, False

        def back(frame: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame(
                {
                    "a": frame["fp"], "b": frame["part"], "mask": frame["mask"],
                    "start": frame["start"], "width": frame["width"],
                }
            )

        def close() -> None:
            if size > 1 and not over:
                _compare(np.concatenate([k["fp"].to_numpy() for k in kept]), forest, max_bits)

        for frame in batches:
            if not len(frame):
                continue
            mask, part = frame["mask"].to_numpy(), frame["part"].to_numpy()
            cut = np.flatnonzero((mask[1:] != mask[:-1]) | (part[1:] != part[:-1])) + 1
            starts = np.concatenate([[0], cut])
            ends = np.concatenate([cut, [len(frame)]])
            fps = frame["fp"].to_numpy()
            # whole keys of two inside the batch, at once
            two = np.flatnonzero((ends - starts == 2) & (starts > 0) & (ends < len(frame)))
            a, b = fps[starts[two]], fps[starts[two] + 1]
            near = _distance(a, b) <= max_bits
            for x, y in zip(a[near].tolist(), b[near].tolist()):
                forest.link(x, y)
            edge = (starts == 0) | (ends == len(frame))
            for k in np.flatnonzero((ends - starts > 2) | edge):
                s, e = starts[k], ends[k]
                key = (mask[s], part[s])
                if key != open_key:
                    close()
                    kept, open_key, size, over = [], key, 0, False
                kept.append(frame.iloc[s:e])
                size += e - s
                over = over or (size > limit and frame["width"].iloc[s] > 8)
                if over:
                    for part_ in kept:
                        yield back(part_)
                    kept = []
        close()
        yield forest.rows()

    return run


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS, limit: int = GROUP_LIMIT) -> DataFrame:
    """Edges ``(a, b)`` between distinct ``fp`` whose closure is that of all links.

    Every pair within ``max_bits`` (at most three) is compared; of the links a
    task finds it returns a forest, so that their number stays below the rows
    it read.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves find distances of at most three bits")
    rows = fingerprints.select("fp").distinct()
    found = None
    for level in range(3):
        if level == 0:
            masks = _mask_array(_variants(0, 64))
        else:
            width = 64 >> level
            masks = F.array().cast(T.ArrayType(_V))
            for start in range(0, 64, width):
                own = F.transform(
                    _mask_array(_variants(start, width)),
                    lambda v: F.struct(
                        v["mask"].bitwiseOR(F.col("mask")).alias("mask"),
                        v["start"].alias("start"),
                        v["width"].alias("width"),
                    ),
                )
                masks = F.when(F.col("start") == start, own).otherwise(masks)
        keyed = _keyed(rows, masks)
        parts = keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")
        out = stored(
            keyed.repartition(int(parts), "mask", "part")
            .sortWithinPartitions("mask", "part", "fp")
            .mapInPandas(_link_groups(max_bits, limit), LINKS),
            "simhash-links",
        )
        pairs = out.where("start < 0").select("a", "b")
        found = pairs if found is None else found.union(pairs)
        rows = out.where("start >= 0").select(F.col("a").alias("fp"), "mask", "start", "width").distinct()
        if rows.isEmpty():
            break
    return found.distinct()


_V = T.StructType(
    [
        T.StructField("mask", T.LongType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
    ]
)


def near_duplicates(
    docs: DataFrame,
    words_in_shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs (doc_id, text)``.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits. Null and empty texts have fingerprint zero and
    link like any other; a null doc_id takes part, but names a component only
    if no other does (null). Repeated rows come back as often as they stand
    there. An empty table gives no rows; other columns are not read.
    """
    session(docs.sparkSession)
    prints = stored(
        docs.select(F.col("doc_id"), fingerprint(F.col("text"), words_in_shingle).alias("fp")),
        "simhash-fp",
    )
    named = _rooted(prints, max_bits, limit).select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def _rooted(prints: DataFrame, max_bits: int, limit: int) -> DataFrame:
    """``(fp, root, component_id)`` of every distinct fingerprint."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    groups = components(links(nodes, max_bits, limit)).select(F.col("node").alias("fp"), "root")
    rooted = nodes.join(groups, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root")


def keep_first(
    docs: DataFrame,
    words_in_shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """The documents with one row of each group: that with the smallest doc_id, nulls last.

    Rows that share a doc_id are told apart by their text, so a doc_id or a null
    that stands in several groups keeps a row in each it is the smallest of. Of
    different texts under one doc_id in one group, that with the smallest hash
    stays; of repeated rows, that with the smallest row hash. All columns are kept
    as they are. An empty table gives no rows.
    """
    session(docs.sparkSession)
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    prints = stored(
        docs.select(F.col("doc_id"), mark.alias("mark"), fingerprint(F.col("text"), words_in_shingle).alias("fp")),
        "simhash-fp",
    )
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    # the smallest row of each fingerprint first, then of each group: no group is gathered
    firsts = prints.groupBy("fp").agg(F.min(order).alias("row"))
    keeper = (
        firsts.join(_rooted(prints, max_bits, limit).select("fp", "root"), "fp")
        .groupBy("root")
        .agg(F.min("row").alias("row"))
        .select(F.col("row.doc_id").alias("_keep_id"), F.col("row.mark").alias("_keep_mark"))
    )
    rank = fresh(docs, "_rank")
    same = docs["doc_id"].eqNullSafe(keeper["_keep_id"]) & (mark == keeper["_keep_mark"])
    one = Window.partitionBy("doc_id", mark).orderBy(F.xxhash64(*docs.columns))
    kept = docs.join(keeper, same, "left_semi")
    return kept.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1).drop(rank)
