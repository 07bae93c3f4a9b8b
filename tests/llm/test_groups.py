"""Near-duplicates and the pipeline, against brute force."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from curbflow.llm import components, quality, queries, simhash, vectors


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(200)] + [(5, 5), (7, 6), (7, 6), (500, 300), (400, 500)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.components(df).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(200))
    assert got[500] == got[400] == got[300] == 300
    assert components.components(df.where("false")).isEmpty()


# SimHash


def simhash_brute(rows):
    prints = [brute.fingerprint(t) for _, t in rows]
    x = np.array(prints, np.uint64)
    root = brute.closure(len(x), np.bitwise_count(x[:, None] ^ x[None, :]) <= 3)
    return prints, [min((rows[j][0] for j in np.flatnonzero(root == r) if rows[j][0] is not None), default=None) for r in root]


def test_simhash_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    prints, roots = simhash_brute(docs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op8_simhash_near_dedup(spark, sf).collect()}
    assert got == {d: (f"{p:016x}", r) for (d, _), p, r in zip(docs, prints, roots)}


def test_simhash_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    prints, roots = simhash_brute(rows)
    key = lambda x: tuple(-1 if v is None else v for v in x)
    want = sorted([(d, p - (1 << 64) if p >> 63 else p, r) for (d, _), p, r in zip(rows, prints, roots)], key=key)
    assert sorted(map(tuple, simhash.near_duplicates(odd).collect()), key=key) == want
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots))
    # ids that stand in several groups, as nulls do, keep a row in each
    words = [" ".join(f"{w}{i}" for i in range(30)) for w in ("red", "blue", "green", "grey")]
    rows = [(None, words[0]), (None, words[1]), (None, words[1]), (7, words[2]), (7, words[3]), (7, words[3]), (9, words[3]), (8, words[0])]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id or 0), r.text) for r in kept.collect()) == sorted([(8, words[0]), (0, words[1]), (7, words[2]), (7, words[3])])
    assert simhash.near_duplicates(none).isEmpty() and simhash.keep_first(none).isEmpty()


@pytest.mark.parametrize("limit", [2, 40, 8192])
def test_hot_keys_are_refined_not_cut(spark, limit):
    rng = np.random.default_rng(5)
    near = np.uint64(0x123456789ABCDEF0)
    flips = [sum(1 << int(b) for b in rng.choice(30, rng.integers(0, 7), replace=False)) for _ in range(400)]
    x = np.unique(np.concatenate([near ^ np.array(flips, np.uint64), rng.integers(0, 1 << 63, 200).astype(np.uint64)]))
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    root = brute.closure(len(x), np.bitwise_count(x[:, None] ^ x[None, :]) <= 3)
    got = {r.node: r.root for r in components.components(simhash.links(df, limit=limit)).collect()}
    groups = lambda labels: sorted(len(g) for g in _groups(labels))
    signed = x.view(np.int64).tolist()
    assert groups([got.get(v, v) for v in signed]) == groups(root.tolist())


def test_top_bit_counts_like_any_other(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    near = base ^ np.array([(1 << 63) | sum(1 << int(b) for b in rng.choice(63, i % 4, replace=False)) for i in range(60)], np.uint64)
    far = base[:20] ^ np.uint64(0xFFFF << 48)  # as a signed number one bit apart
    signed = np.concatenate([base, near, far]).view(np.int64).tolist()
    # bits over both sizes of key: two fingerprints, and more
    for more in ([], [v ^ 1 for v in signed]):
        every = np.array(signed + more, np.int64)
        root = brute.closure(len(every), np.bitwise_count((every[:, None] ^ every[None, :]).view(np.uint64)) <= 3)
        df = spark.createDataFrame([(v,) for v in every.tolist()], "fp long")
        got = {r.node: r.root for r in components.components(simhash.links(df)).collect()}
        assert sorted(map(sorted, _groups([got.get(v, v) for v in every.tolist()]))) == sorted(map(sorted, _groups(root.tolist())))


def _groups(labels):
    out = {}
    for i, x in enumerate(labels):
        out.setdefault(x, []).append(i)
    return out.values()


# vectors


def vector_brute(rows):
    units = [vectors.unit(v) for _, v in rows]
    linked = np.array([[a is not None and b is not None and i != j and float(a @ b) >= 0.95 for j, b in enumerate(units)] for i, a in enumerate(units)])
    root = brute.closure(len(rows), linked)
    return {rows[i][0]: (int(linked[i].sum()), min(rows[j][0] for j in np.flatnonzero(root == root[i]))) for i in range(len(rows))}


def planted(seed=1, groups=40, size=12, dim=32):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        c = rng.normal(size=dim)
        out += [(c + rng.normal(size=dim) * 0.04 * np.linalg.norm(c) / np.sqrt(dim) * rng.integers(1, 4)).tolist() for _ in range(size)]
    out += rng.normal(size=(150, dim)).tolist()
    return list(enumerate(out))


@pytest.mark.parametrize("rows, most", [(100, 6000), (100, 60), (25, 60)])
def test_vectors_match_brute_force(spark, rows, most):
    """One level of shards, blocks of shards that stay whole, and shards cut again."""
    vecs = planted()
    want = vector_brute(vecs)
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(df, shard_rows=rows, shard_most=most).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] <= want[k][0] for k in want)
    assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values())
    assert sum(got[k][1] == want[k][1] for k in want) >= 0.98 * len(want)


def test_dense_group_gives_no_pairs(spark):
    """Near copies: each links with all others, and what tasks return grows with the nodes alone."""
    rng = np.random.default_rng(3)
    c = rng.normal(size=16)
    x = [(c + rng.normal(size=16) * 0.01).tolist() for _ in range(700)] + rng.normal(size=(300, 16)).tolist()
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    nodes = spark.createDataFrame([(i, vectors.unit(v).tolist(), 1, i % 50 == 0) for i, v in enumerate(x)], vectors.NODE)
    found = vectors.links(nodes, rows=100, most=200)
    assert found.edges.count() < 60 * len(x) and found.counts.count() <= len(x)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(df, shard_rows=100, shard_most=200).collect()}
    want = vector_brute(list(enumerate(x)))
    assert all(got[i][0] >= 0.99 * want[i][0] for i in range(700)) and all(got[i] <= want[i] for i in want)
    assert {got[i][1] for i in range(700)} == {0}


def test_vector_odd_rows(spark):
    one = [0.1, 0.2, 0.3]
    rows = [(5, one), (2, one), (9, [0.2, 0.4, 0.6]), (1, None), (3, []), (4, [0.0, 0.0, 0.0]), (6, [1.0, None, 0.0]),
            (7, [float("nan"), 1.0, 0.0]), (8, [float("inf"), 1.0, 0.0]), (10, [1e30, 2e30, 3e30]), (11, [-1.0, 0.0, 0.0]), (2, one)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit(1))
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect())
    alone = [(i, 0, i, True) for i in (1, 3, 4, 6, 7, 8, 11)]
    assert got == sorted([*alone, (2, 4, 2, True), (2, 4, 2, True), (5, 4, 2, False), (9, 4, 2, False), (10, 4, 2, False)])
    assert vectors.near_duplicates(df.where("false")).isEmpty()
    floats = df.select("vec_id", df.embedding.cast("array<float>").alias("embedding"))
    assert vectors.near_duplicates(floats).count() == len(rows)
    mixed = spark.createDataFrame([(1, one), (2, one[:2]), (3, one[:2]), (4, [*one, 0.0])], "vec_id long, embedding array<double>")
    assert sorted((r.vec_id, r.n_links) for r in vectors.near_duplicates(mixed).collect()) == [(1, 0), (2, 1), (3, 1), (4, 0)]


def test_vector_query_recall(spark, tmp_path):
    """The query over a table with planted links, as its tables hold few."""
    rng = np.random.default_rng(11)
    given = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toPandas()
    x = np.stack(given.embedding).astype(float)
    near = [v + rng.normal(size=len(v)) * 0.15 * np.linalg.norm(v) / np.sqrt(len(v)) for v in x[:200] for _ in range(1 + rng.integers(3))]
    every = np.concatenate([x, near])
    rows = [(int(i), v.tolist(), 0) for i, v in enumerate(every)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    every = every.astype(np.float32).astype(float)
    every /= np.linalg.norm(every, axis=1)[:, None]
    true = (every @ every.T >= 0.95).sum(1) - 1
    got = {r.vec_id: r.n_links for r in queries.op10_vector_near_dedup(spark, str(tmp_path)).collect()}
    assert true.sum() > 400 and all(got[k] <= n for k, n in enumerate(true))
    assert sum(got.values()) >= 0.9 * true.sum()


def _sparse(spark, n=3000, every=60, dim=64):
    """Nodes of which few have one near neighbour, and the pairs."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, dim))
    for i in range(0, n, every):
        x[i + 1] = x[i] + rng.normal(size=dim) * 0.2
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, v.tolist(), 1, i % 20 == 0) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, vectors.NODE), {(i, i + 1) for i in range(0, n, every)}


def test_audit_counts_every_query(spark, monkeypatch):
    nodes, want = _sparse(spark)
    true = {r.node: r.others for r in vectors.true_counts(nodes).collect()}
    assert len(true) == 150 and {k for k, n in true.items() if n} == {a for a, _ in want}
    none = spark.createDataFrame([], "node long, others long"), spark.createDataFrame([], "a long, b long")
    asked = []

    def blind(nodes, centers, least, overlap, rows, most):
        asked.append(overlap)
        return none

    monkeypatch.setattr(vectors, "_round", blind)
    with pytest.raises(RuntimeError, match="recall 0.000"):  # too few links to trust a recall: more overlap at once
        vectors.links(nodes)
    assert asked == [4, 8]
    monkeypatch.setattr(vectors, "AUDIT_LINKED", 20)
    with pytest.raises(RuntimeError, match="recall 0.000"):  # audited at the most overlap, too
        vectors.links(nodes)
    assert asked[2:] == [2, 4, 8]


def test_planted_pairs_are_found(spark):
    nodes, want = _sparse(spark)
    found = vectors.links(nodes, rows=100)
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in found.edges.collect()}
    assert len(want & got) >= 0.9 * len(want) and got <= want
    assert found.recall >= 0.9 and found.queries == 150 and found.linked == 50
    assert {r.node for r in found.counts.collect()} == {n for pair in got for n in pair}


# the pipeline


def test_pipeline_follows_its_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    judged = quality.judged(docs, quality.trusted_ids(labels)).collect()
    good = [r for r in judged if r.verdict.kept]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "simhash_near_dedup", "pii_sanitised", "source_mixing", "packing"]
    first = stages["quality_rules"](spark, docs, small)
    assert first.columns == docs.columns and {r.doc_id for r in first.collect()} == {r.doc_id for r in good}
    second = stages["simhash_near_dedup"](spark, first, small)
    assert sorted(r.doc_id for r in second.collect()) == sorted(set(simhash_brute([(r.doc_id, r.text) for r in good])[1]))
    third = stages["pii_sanitised"](spark, second, small)
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in (second, third))
    assert before.keys() == after.keys() and third.columns == docs.columns
    assert all(not brute.pii(t) for t in after.values())
    assert all(after[k] == t for k, t in before.items() if not brute.pii(t))
    fourth = stages["source_mixing"](spark, third, small)
    kept = {r.doc_id for r in fourth.collect()}
    assert kept <= after.keys() and len(kept) > 0.5 * len(after)
    rows = corpus_pipeline.run(spark, small).collect()
    assert {r.doc_id for r in rows} == kept
