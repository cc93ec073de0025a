"""Epsilon grid order join against all pairs, and components against a plain union."""

import random

import numpy as np
from pyspark.sql import functions as F

from tillsight.llm import grid_join as g
from tillsight.llm.components import components

SF = "/root/testdata/sf0.001"


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, cosine):
    good = [(i, np.asarray(v, float)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = [(k, m) for k, (_, x) in enumerate(good) for m, (_, y) in enumerate(good)
             if k < m and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= cosine]
    n = [0] * len(good)
    for k, m in links:
        n[k] += 1
        n[m] += 1
    root = roots([i for i, _ in good], [(good[k][0], good[m][0]) for k, m in links])
    out = [(i, n[k], root[i], i == root[i]) for k, (i, _) in enumerate(good)]
    used = {i for i, _ in good}
    return out + [(i, 0, i, True) for i, _ in rows if i is None or i not in used]


def test_components_match_union(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(60)] + [(500, k) for k in range(501, 600)] + [(9, 9)]
    links += [(rng.randint(700, 900), rng.randint(700, 900)) for _ in range(90)]
    rng.shuffle(links)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = roots({x for p in links for x in p}, links)
    linked = {x for u, v in links if u != v for x in (u, v)}
    assert got == {n: want[n] for n in linked}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(n // 12, 1), dim))
    return (centres[rng.integers(len(centres), size=n)] + rng.normal(size=(n, dim)) * 0.18).astype(np.float32)


def test_matches_all_pairs(spark):
    for dim, n in ((3, 250), (24, 300)):
        rows = [(k * 3 % 1009, [float(x) for x in v]) for k, v in enumerate(clustered(n, dim, dim))]
        got = g.join_vectors(spark.createDataFrame(rows, "vec_id long, v array<float>"), block=40)
        assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 0.9))


def test_distant_blocks_are_skipped(spark):
    rng = np.random.default_rng(0)
    x = np.r_[rng.normal(size=(200, 4)) * 0.02 + [1, 0, 0, 0], rng.normal(size=(200, 4)) * 0.02 + [-1, 0, 0, 0]]
    rows = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)], "id long, v array<double>, copies long")
    eps = (2 - 2 * 0.9) ** 0.5
    sequence = g.blocks(rows, 4, eps, g.directions(rows, 4, 4), 50)
    n = sequence.count()
    assert g.near_pairs(sequence, eps).count() < n * (n + 1) // 2


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, g.op6_grid_join(spark, SF).collect())) == sorted(brute(rows, 0.9))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, []),
            (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 0.0, 0.0]), (11, [1.0]), (12, [-1.0, 0.0]),
            (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<float>").withColumn("n_links", F.lit(7))
    got = sorted(map(tuple, g.join_vectors(df.select("vec_id", "v")).collect()), key=str)
    assert got == sorted(brute(rows, 0.9), key=str)
    assert g.join_vectors(df.filter(F.lit(False))).count() == 0
    assert g.join_vectors(df.filter("vec_id = 5")).count() == 1


def all_pairs(x, y, cosine):
    return {(i, j) for i, p in enumerate(x) for j, q in enumerate(y) if p @ q / (np.sqrt(p @ p) * np.sqrt(q @ q)) >= cosine}


def test_blocks_of_several_leaves():
    rng = np.random.default_rng(4)
    for dim, n in ((24, 600), (64, 300)):
        near = rng.normal(size=dim) + rng.normal(size=(400, dim)) * 0.1
        far = rng.normal(size=(2, n, dim))
        sides = [np.r_[x[:100], near[k::2], x[100:]].astype(kind) for k, (x, kind) in enumerate(zip(far, ("<f4", "<f8")))]
        axes = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        a, b = (g.Block(np.arange(len(x)).astype("<i8").tobytes(), np.ones(len(x), "<i8").tobytes(), x.tobytes(), axes, 8)
                for x in sides)
        for cosine in (0.5, 0.9):
            got = [p for i, j in g.linked(a, b, cosine, (2 - 2 * cosine) ** 0.5) for p in zip(i.tolist(), j.tolist())]
            want = all_pairs(*(x.astype(float) for x in sides), cosine)
            assert len(got) == len(set(got)) and set(got) == want and len(want) > 1000


def test_chain_through_many_blocks(spark):
    rng = np.random.default_rng(6)
    turn = np.arange(150) * 0.35  # cos 0.35 is over 0.9, cos 0.7 is not; a spiral, so that turns do not meet
    height = np.arange(150) * 0.2 - 15
    spiral = np.c_[np.cos(turn) * 10, np.sin(turn) * 10, height]
    ids = rng.permutation(5000)[:600]
    rows = [(int(k), [float(x) for x in v]) for k, v in zip(ids, np.r_[spiral, spiral * 2, rng.normal(size=(300, 3))])]
    rows += [(9000, [0.0, 1.0, 0.0]), (9001, [-0.0, 1.0, 0.0]), (9000, [0.0, 1.0, 0.0]), (9002, [1e200, 0.0, 0.0]), (9003, [1e-200, 0.0, 0.0])]
    for cosine in (0.9, 0.999):
        got = g.join_vectors(spark.createDataFrame(rows, "vec_id long, v array<double>"), cosine=cosine, block=30)
        scaled = [(k, [x / max(map(abs, v)) for x in v]) for k, v in rows]
        assert sorted(map(tuple, got.collect())) == sorted(brute(scaled, cosine))


def test_vectors_of_pairs_are_not_shuffled(spark):
    vectors = [(k, 1, [float(x) for x in v]) for k, v in enumerate(np.random.default_rng(8).normal(size=(600, 16)))]
    rows = spark.createDataFrame(vectors, "id long, copies long, v array<float>")
    eps, axes = (2 - 2 * 0.9) ** 0.5, g.directions(rows, 16, 16)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of any size
    try:
        sequence = g.blocks(rows, 16, eps, axes[:, :8], 50)
        pairs = g.near_pairs(sequence, eps)
        assert pairs.count() > 2 * sequence.count()
        met = g.compare(sequence, pairs, axes, 0.9, eps)
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert [x for x in plan.splitlines() if "Exchange" in x and "BroadcastExchange" not in x] == []
        assert sequence.schema["raw"].dataType.simpleString() == "binary"
        assert sequence.agg(F.sum(F.length("raw"))).first()[0] == 600 * 16 * 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
