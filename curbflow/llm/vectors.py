"""Near-duplicate vectors through a robust-pruned flat graph.

Equal vectors are one node. Centroids fitted on a bounded sample cut the nodes
into shards, each node joining its nearest ones, so that shards overlap; shards that are
still too large are cut again by centroids of their own. Every shard builds a flat graph:
neighbours by similarity, robustly pruned, reverse edges added, every node reachable from
the medoid. The adjacency lists of a node in all its shards are united. Search runs in each
shard over the united lists: greedy from the medoid and the query's own list, and on through
every node found in range, until none is left. Links are pairs whose cosine in double precision reaches the threshold.

Pairs never leave the task that finds them. A node carries the list of its shards, and a pair is
counted in the least shard that both share; what is returned are the links of each node as a number,
and edges of a spanning forest of each shard's links. A group of near copies so gives as many rows as
it has nodes.

Recall is measured in every run: all nodes on the audit's fraction of ids are compared with all
nodes, in blocks dealt over tasks, and their links counted. If too many were missed, everything is
done again with more overlap; a recall below the promised one at the most overlap is an error.

A shard of nodes too alike for centroids to cut is dealt into blocks, each with a graph of its
own, and every pair of blocks is searched both ways: tasks stay bounded and nothing is left out.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbflow.llm.common import session, stored
from curbflow.llm.components import components

MIN_COSINE = 0.95
#: Nodes a shard aims at, and above which it is cut again or dealt into blocks.
SHARD_ROWS, SHARD_MOST = 2000, 6000
#: Nodes that centroids are fitted on at most, and centroids at most, of the table and of each shard that is cut.
SAMPLE_ROWS, MAX_CENTROIDS = 20_000, 4096
#: A shard is cut again only while that leaves at most this share of it in one part.
CUT_SHARE = 0.8
#: Nodes of a cut shard that meet its centroids in one task.
CUT_ROWS = 50_000
#: Graph: neighbours considered, neighbours kept, slack of the pruning rule.
NEAR, DEGREE, ALPHA = 48, 16, 1.2
BEAM = 24
#: Shards a node joins at first and at most.
OVERLAP, MOST_OVERLAP = 2, 8
#: Ids that this divides are the audit's queries; queries and nodes of one of its tasks.
AUDIT_EVERY, AUDIT_QUERIES, AUDIT_NODES = 50, 4096, 20_000
#: Queries with links below which a measured recall says little, and overlap starts twice as large.
AUDIT_LINKED = 100
#: Share of their links that must be found, and below which the result is refused at the most overlap.
AUDIT_RECALL, LEAST_RECALL = 0.97, 0.9

NODE = "node long, vector array<double>, copies long, audited boolean"
_LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class Links:
    """What search found: ``counts (node, others)``, forest ``edges (a, b)``, and the audit's figures."""

    counts: DataFrame
    edges: DataFrame
    recall: float
    queries: int
    linked: int
    overlap: int


def unit(vector) -> np.ndarray | None:
    """The vector at length one; None if it links with nothing."""
    if vector is None:
        return None
    v = np.array([np.nan if x is None else x for x in vector], np.float64)
    if not len(v) or not np.isfinite(v).all():
        return None
    v = v / max(np.abs(v).max(), np.finfo(np.float64).tiny)  # the square of a very large number would overflow
    size = np.sqrt((v * v).sum())
    return v / size if size > 0 else None


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        vectors = [unit(v) for v in frame["embedding"]]
        good = [v is not None for v in vectors]
        yield frame[good].drop(columns="embedding").assign(vector=[v for v in vectors if v is not None])


def _fitted(sample: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means."""
    centers = sample[:: max(1, len(sample) // k)][:k].copy()
    for _ in range(10):
        label = (sample @ centers.T).argmax(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, label, sample)
        sizes = np.linalg.norm(sums, axis=1)
        centers = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1e-300)[:, None], centers)
    return centers


def _centroids(nodes: DataFrame, count: int) -> np.ndarray:
    """Centroids of the nodes with the smallest hashes."""
    rows = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE_ROWS).select("vector").collect()
    return _fitted(np.array([r[0] for r in rows]), min(max(1, -(-count // SHARD_ROWS)), MAX_CENTROIDS))


def _nearest(x: np.ndarray, centers: np.ndarray, overlap: int) -> np.ndarray:
    m = max(1, min(overlap, len(centers) - 1))  # all shards of each would be one shard many times
    return np.argpartition(-(x @ centers.T), m - 1, axis=1)[:, :m]


def _assigned(centers: np.ndarray, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            if len(frame):
                near = _nearest(np.stack(frame["vector"].to_list()), centers, overlap)
                yield frame.iloc[np.repeat(np.arange(len(frame)), near.shape[1])].assign(shard=near.ravel())

    return run


def _sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("shard").agg(F.count("*").alias("n"))


def _cut(members: DataFrame, rows: int, most: int, overlap: int) -> DataFrame:
    """Members of shards above ``most`` nodes given to centroids of their own shard, until none can be cut.

    Centroids of a shard are fitted on a sample of its own, and meet its nodes in parts of bounded
    size. Numbers of new shards extend those of the old; a shard whose nodes are too alike stays as it is.
    """
    schema = f"shard long, {NODE}"
    members = members.withColumn("whole", F.lit(False))
    while True:
        sizes = stored(_sizes(members.where("not whole")).where(F.col("n") > most), "vector-sizes")
        if sizes.isEmpty():
            return members.drop("whole")
        named = sizes.withColumnRenamed("shard", "_shard")
        large = members.join(named, (F.col("shard") == F.col("_shard")) & ~F.col("whole"))
        part = F.pmod(F.xxhash64("node", F.lit(3)), F.ceil(F.col("n") / CUT_ROWS)).cast("int")
        large = large.select("shard", "n", part.alias("part"), "node", "vector", "copies", "audited")
        drawn = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 40)) < F.lit(float(1 << 40)) * SAMPLE_ROWS / 2 / F.col("n")

        def fitted(frame: pd.DataFrame) -> pd.DataFrame:
            sample = np.stack(frame.sort_values("node")["vector"].to_list())
            centers = _fitted(sample, min(MAX_CENTROIDS, -(-int(frame["n"].iloc[0]) // rows), len(sample)))
            return pd.DataFrame({"shard": frame["shard"].iloc[0], "i": range(len(centers)), "center": list(centers)})

        centers = stored(
            large.where(drawn).select("shard", "n", "node", "vector").groupBy("shard").applyInPandas(fitted, "shard long, i int, center array<double>"),
            "vector-centers",
        )
        parts = large.select(F.col("shard").alias("_shard"), F.col("part").alias("of")).distinct()
        dealt = centers.join(parts, F.col("shard") == F.col("_shard")).drop("_shard")

        def assigned(frame: pd.DataFrame, of: pd.DataFrame) -> pd.DataFrame:
            of = of.sort_values("i")
            if not len(of) or not len(frame):
                return frame.drop(columns=["n", "part"])
            near = _nearest(np.stack(frame["vector"].to_list()), np.stack(of["center"].to_list()), overlap)
            out = frame.iloc[np.repeat(np.arange(len(frame)), near.shape[1])].drop(columns=["n", "part"])
            return out.assign(shard=(out["shard"].to_numpy() + 1) * MAX_CENTROIDS + near.ravel())

        new = stored(
            large.groupBy("shard", "part").cogroup(dealt.groupBy("shard", "of")).applyInPandas(assigned, schema), "vector-cut"
        )
        # a shard that stays nearly whole is done
        old = named.select((F.col("_shard") + 1).alias("_old"), F.col("n").alias("before"))
        grown = _sizes(new).join(old, F.expr(f"shard div {MAX_CENTROIDS}") == F.col("_old"))
        stays = grown.select(F.col("shard").alias("_new"), (F.col("n") > CUT_SHARE * F.col("before")).alias("stays"))
        parted = new.join(stays, F.col("shard") == F.col("_new"), "left").withColumn("whole", F.coalesce("stays", F.lit(True))).drop("_new", "stays")
        rest = members.join(named, (F.col("shard") == F.col("_shard")) & ~F.col("whole"), "left_anti")
        members = stored(rest.unionByName(parted), "vector-shards")


def _pruned(x: np.ndarray) -> list[list[int]]:
    """Robustly pruned neighbours of every vector, reverse edges included."""
    n = len(x)
    edges: list[set[int]] = [set() for _ in range(n)]
    k = min(NEAR, n - 1)
    for at in range(0, n, 512):
        sims = x[at : at + 512] @ x.T
        sims[np.arange(len(sims)), np.arange(at, at + len(sims))] = -2
        near = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k else np.zeros((len(sims), 0), int)
        for row, ids in enumerate(near):
            ids = ids[np.argsort(-sims[row, ids], kind="stable")]
            far = 1 - sims[row, ids]
            between = 1 - x[ids] @ x[ids].T
            left = np.ones(len(ids), bool)
            for j in range(len(ids)):
                if left[j]:
                    edges[at + row].add(int(ids[j]))
                    if len(edges[at + row]) >= DEGREE:
                        break
                    left &= ALPHA * between[j] > far
    for i, out in enumerate([*map(tuple, edges)]):
        for j in out:
            edges[j].add(i)
    return [sorted(e) for e in edges]


def _medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(0)).argmax())


def _reachable(x: np.ndarray, edges: list[list[int]]) -> None:
    """Add edges until the medoid reaches every node: each missed part through its closest pair tried."""
    seen = np.zeros(len(x), bool)

    def walk(start: int) -> None:
        stack = [start]
        seen[start] = True
        while stack:
            for j in edges[stack.pop()]:
                if not seen[j]:
                    seen[j] = True
                    stack.append(j)

    walk(_medoid(x))
    while not seen.all():
        i = int(np.flatnonzero(~seen)[0])
        j = int(np.where(seen, x @ x[i], -2).argmax())
        edges[i].append(j)
        edges[j].append(i)
        walk(i)


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    """Adjacency lists of one block of a shard, as node numbers."""
    frame = frame.sort_values("node")
    x, ids = np.stack(frame["vector"].to_list()), frame["node"].to_numpy()
    edges = _pruned(x)
    _reachable(x, edges)
    return pd.DataFrame({"node": ids, "near": [ids[e].tolist() for e in edges]})


def _search(x: np.ndarray, edges: list[np.ndarray], q: np.ndarray, start: np.ndarray, least: float) -> np.ndarray:
    """Nodes found in range of ``q``: from ``start`` best first, on through every node in range."""
    n = len(x)
    sims = np.full(n, -3.0)  # not seen yet
    done = np.zeros(n, bool)
    seen = start
    sims[start] = x[start] @ q
    while True:
        value = sims[seen]
        best = seen[np.argsort(-value, kind="stable")[:BEAM]] if len(seen) > BEAM else seen
        todo = np.union1d(best[~done[best]], seen[(value >= least) & ~done[seen]])
        if not len(todo):
            return seen[value >= least]
        done[todo] = True
        new = np.unique(np.concatenate([edges[i] for i in todo]))
        new = new[sims[new] == -3.0]
        sims[new] = x[new] @ q
        seen = np.concatenate([seen, new])


def _hits(base: pd.DataFrame, queries: pd.DataFrame, least: float) -> np.ndarray:
    """Whether search from each query finds each base node, the query itself left out."""
    x, ids = np.stack(base["vector"].to_list()), base["node"].to_numpy()

    def here(near: np.ndarray) -> np.ndarray:
        at = np.searchsorted(ids, near)
        at[at == len(ids)] = 0
        return at[ids[at] == near]  # united lists name nodes of other shards too

    edges = [here(near) for near in base["near"]]
    medoid, hit = _medoid(x), np.zeros((len(queries), len(base)), bool)
    for k, (node, q, near) in enumerate(zip(queries["node"], queries["vector"], queries["near"])):
        found = _search(x, edges, q, np.union1d([medoid], here(near)), least)
        hit[k, found[ids[found] != node]] = True
    return hit


def _lists(frame: pd.DataFrame) -> np.ndarray:
    """Shards of every node in rising order, filled up with -1."""
    out = np.full((len(frame), max(map(len, frame["shards"]))), -1, np.int64)
    for k, shards in enumerate(frame["shards"]):
        out[k, : len(shards)] = np.sort(shards)
    return out


def _owned(own: np.ndarray, others: np.ndarray, shard: int) -> np.ndarray:
    """Which of ``others`` share no smaller shard with a node."""
    smaller = own[(own >= 0) & (own < shard)]
    return ~np.isin(others, smaller).any(axis=1)


def _forest(hit: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between two lists of nodes (the same list twice, or two)."""
    same = left is right
    new = [np.ones(len(left), bool), np.ones(len(right), bool)]
    if same:
        new[1] = new[0]
    edges: list[tuple[int, int]] = []
    for root in range(len(left)):
        if not new[0][root]:
            continue
        new[0][root] = False
        stack = [(0, root)]
        while stack:
            side, i = stack.pop()
            to = 0 if same else 1 - side
            row = hit[i] if side == 0 else hit[:, i]
            names, ours = ((right, left) if side == 0 else (left, right))
            found = np.flatnonzero(row & new[to])
            new[to][found] = False
            edges += [(int(ours[i]), int(names[j])) for j in found]
            stack += [(to, int(j)) for j in found]
    return edges


def _searched(least: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """Links of one block of a shard, or between two: counts ``(a, null, others)`` and edges ``(a, b, null)``."""
        frame = frame.sort_values("node")
        shard, i, j = (int(frame[k].iloc[0]) for k in ("shard", "i", "j"))
        one = frame[frame["block"] == i]
        two = one if i == j else frame[frame["block"] == j]
        if not len(one) or not len(two):
            return pd.DataFrame({"a": [], "b": [], "others": []}, dtype="Int64")
        hit = _hits(two, one, least)  # rows: one, columns: two
        hit |= hit.T if i == j else _hits(one, two, least).T
        lists = (_lists(one), _lists(two))
        copies = (one["copies"].to_numpy(), two["copies"].to_numpy())
        ids = (one["node"].to_numpy(), two["node"].to_numpy())
        sums = [np.zeros(len(one), np.int64), np.zeros(len(two), np.int64)]
        for k in range(len(one)):
            found = np.flatnonzero(hit[k])
            found = found[_owned(lists[0][k], lists[1][found], shard)]
            sums[0][k] += copies[1][found].sum()
            if i != j:
                sums[1][found] += copies[0][k]
        sides = (0,) if i == j else (0, 1)
        counts = np.array([(n, c) for side in sides for n, c in zip(ids[side], sums[side]) if c], np.int64).reshape(-1, 2)
        edges = np.array(_forest(hit, ids[0], ids[0] if i == j else ids[1]), np.int64).reshape(-1, 2)
        # numbers beside nulls stay whole numbers only if no float comes between
        return pd.DataFrame({
            "a": np.concatenate([counts[:, 0], edges[:, 0]]),
            "b": pd.array([None] * len(counts) + edges[:, 1].tolist(), "Int64"),
            "others": pd.array(counts[:, 1].tolist() + [None] * len(edges), "Int64"),
        })

    return run


def _round(nodes: DataFrame, centers: np.ndarray, least: float, overlap: int, rows: int, most: int) -> tuple[DataFrame, DataFrame]:
    """``counts (node, others)`` and ``edges (a, b)`` that search finds with each node in ``overlap`` shards."""
    first = stored(nodes.mapInPandas(_assigned(centers, overlap), f"{NODE}, shard long"), "vector-shards")
    members = _cut(first.select("shard", "node", "vector", "copies", "audited"), rows, most, OVERLAP)
    blocks = _sizes(members).select(F.col("shard").alias("_shard"), F.ceil(F.col("n") / most).cast("int").alias("blocks"))
    dealt = stored(
        members.join(blocks, F.col("shard") == F.col("_shard")).drop("_shard")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")),
        "vector-blocks",
    )
    graph = stored(dealt.groupBy("shard", "block").applyInPandas(_build, "node long, near array<long>"), "vector-graph")
    united = graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    shards = dealt.groupBy("node").agg(F.sort_array(F.collect_list("shard")).alias("shards"))  # overlap^levels of them
    full = dealt.join(united.join(shards, "node"), "node")
    # a block meets itself and every other once
    every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))
    paired = full.select("shard", F.inline(every), "block", "node", "vector", "copies", "near", "shards")
    found = stored(paired.groupBy("shard", "i", "j").applyInPandas(_searched(least), "a long, b long, others long"), "vector-links")
    counts = found.where("others IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("others").alias("others"))
    return counts, found.where("b IS NOT NULL").select("a", "b")


def true_counts(nodes: DataFrame, least: float = MIN_COSINE) -> DataFrame:
    """``(node, others)`` of every audited node, by comparing them with all nodes in blocks over tasks."""
    asked, total = nodes.where("audited").count(), nodes.count()
    blocks, parts = -(-asked // AUDIT_QUERIES), -(-total // AUDIT_NODES)
    if not blocks:
        return nodes.sparkSession.createDataFrame([], "node long, others long")

    def place(seed: int, n: int):
        return F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(n)).cast("int")

    def all_of(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    queries = nodes.where("audited").select(place(1, blocks).alias("by"), all_of(parts).alias("of"), F.lit(True).alias("asks"), "node", "vector", "copies")
    base = nodes.select(all_of(blocks).alias("by"), place(2, parts).alias("of"), F.lit(False).alias("asks"), "node", "vector", "copies")

    def compared(frame: pd.DataFrame) -> pd.DataFrame:
        q, x = frame[frame["asks"]], frame[~frame["asks"]]
        if not len(q) or not len(x):
            return pd.DataFrame({"node": [], "others": []}).astype("int64")
        all_x, copies, ids = np.stack(x["vector"].to_list()), x["copies"].to_numpy(), x["node"].to_numpy()
        out, asked = np.zeros(len(q), np.int64), np.stack(q["vector"].to_list())
        for at in range(0, len(q), 256):
            near = asked[at : at + 256] @ all_x.T >= least
            near &= q["node"].to_numpy()[at : at + 256, None] != ids
            out[at : at + 256] = near @ copies
        return pd.DataFrame({"node": q["node"].to_numpy(), "others": out})

    counted = queries.unionByName(base).groupBy("by", "of").applyInPandas(compared, "node long, others long")
    return stored(counted.groupBy("node").agg(F.sum("others").alias("others")), "vector-audit")


def _recall(true: DataFrame, counts: DataFrame) -> tuple[float, int, int]:
    """Share of the audit's links that were found, over all links or as the mean of the queries if that is less."""
    got = counts.select("node", F.col("others").alias("got"))
    each = true.join(got, "node", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    r = each.agg(
        F.count("*").alias("queries"), F.count(F.when(F.col("others") > 0, 1)).alias("linked"),
        F.expr("try_divide(sum(got), sum(others))").alias("all"),
        F.avg(F.expr("try_divide(got, others)")).alias("mean"),
    ).first()
    return (1.0 if r["all"] is None else min(r["all"], r["mean"])), r["queries"], r["linked"]


def links(
    nodes: DataFrame, least: float = MIN_COSINE, overlap: int = OVERLAP, rows: int | None = None, most: int | None = None
) -> Links:
    """Links at cosine ``least`` or more of ``nodes (node, vector, copies, audited)``, as numbers and as a forest.

    ``rows`` and ``most`` are the nodes that a shard aims at and may have. Recall is measured on all audited
    nodes and logged. With fewer than ``AUDIT_LINKED`` of them linked it says little, so overlap starts twice as large.
    """
    rows, most = rows or SHARD_ROWS, most or SHARD_MOST
    total = nodes.count()
    spark = nodes.sparkSession
    if not total:
        return Links(spark.createDataFrame([], "node long, others long"), spark.createDataFrame([], "a long, b long"), 1.0, 0, 0, overlap)
    true = true_counts(nodes, least)
    if true.where("others > 0").count() < AUDIT_LINKED:
        overlap = min(2 * overlap, MOST_OVERLAP)
    while True:
        counts, edges = _round(nodes, _centroids(nodes, total), least, overlap, rows, most)
        recall, queries, linked = _recall(true, counts)
        _LOG.info("recall %.4f of the links of %d of %d queries, overlap %d", recall, linked, queries, overlap)
        if recall >= AUDIT_RECALL or overlap >= MOST_OVERLAP:
            break
        overlap = min(2 * overlap, MOST_OVERLAP)
    if recall < LEAST_RECALL:
        raise RuntimeError(f"recall {recall:.3f} of links at overlap {overlap}, {LEAST_RECALL} promised")
    return Links(counts, edges, recall, queries, linked, overlap)


def near_duplicates(rows: DataFrame, least: float = MIN_COSINE, shard_rows: int | None = None, shard_most: int | None = None) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``rows (vec_id, embedding)``.

    ``n_links`` counts other rows linked directly, ``component_id`` is the
    smallest vec_id reachable, ``kept`` says whether it is the row's own. Vectors
    that are null, zero, empty or hold a null or non-finite component link with
    nothing. Rows with equal vectors link with one another, repeated rows
    included; vectors of different length have no cosine and link only with their like.
    An empty table gives no rows; labels and other columns are not read.
    """
    session(rows.sparkSession)
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.col("embedding").isNull() | (F.size("embedding") == 0) | F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ) | F.forall("embedding", lambda x: x == 0)
    # equal vectors are one node, numbered by the hash of its vector; collisions are told apart by the vector
    classes = stored(
        rows.where(~bad).groupBy("embedding").agg(
            F.min("vec_id").alias("first"), F.count("*").alias("copies"),
            F.coalesce(F.max(F.col("vec_id") % AUDIT_EVERY == 0), F.lit(False)).alias("audited"),
        )
        .withColumn("node", F.xxhash64("embedding"))
        .withColumn("twin", F.row_number().over(Window.partitionBy("node").orderBy("embedding")))
        .withColumn("node", F.when(F.col("twin") == 1, F.col("node")).otherwise(F.xxhash64("node", "twin")))
        .drop("twin"),
        "vector-classes",
    )
    counts = edges = None
    for length in sorted(r[0] for r in classes.select(F.size("embedding")).distinct().collect()):
        own = classes.where(F.size("embedding") == length).select("node", "embedding", "copies", "audited")
        nodes = stored(own.mapInPandas(_units, "node long, copies long, audited boolean, vector array<double>").select("node", "vector", "copies", "audited"), "vector-nodes")
        found = links(nodes, least, rows=shard_rows, most=shard_most)
        counts = found.counts if counts is None else counts.union(found.counts)
        edges = found.edges if edges is None else edges.union(found.edges)
    if counts is None:
        counts, edges = classes.select("node", F.col("copies").alias("others")), classes.select(F.col("node").alias("a"), F.col("node").alias("b"))
    roots = components(edges)
    known = (
        classes.join(counts, "node", "left").join(roots, "node", "left")
        .select(
            "embedding", "first", F.coalesce("root", "node").alias("root"),
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    least_id = known.groupBy("root").agg(F.min("first").alias("component_id"))
    named = known.join(least_id, "root").select("embedding", "n_links", "component_id")
    good = rows.where(~bad).join(named, "embedding").select("vec_id", "n_links", "component_id")
    rest = rows.where(bad).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.union(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
