"""Source mixing against its targets and the SQL of the query."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tillsight.llm import mixing as m

SF = "/root/testdata/sf0.01"


def targets(sizes):
    """Share by weight, cap at three times, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        want = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if want[s] > 3 * sizes[s] * (1 + 1e-12)}
        if not over:
            return {**want, **{s: 3 * sizes[s] for s in capped}}
        capped |= over


def brute_mix(rows):
    """(doc_id, size, source) rows to copies, by the same rounding, one source at a time."""
    sizes = {}
    for _, n, s in rows:
        sizes[s] = sizes.get(s, 0) + n
    goal, out = targets(sizes), {}
    for s, mass in sizes.items():
        mine = [(n, i) for i, n, x in rows if x == s]
        count = {}
        for n, _ in mine:
            count[n] = count.get(n, 0) + 1
        mine.sort(key=lambda r: (-r[0], (r[1] % 2147483647 * 48271 % 2147483647) % -(-count[r[0]] // m.ROWS_PER_BLOCK), r[1]))
        rate = min(3.0, goal[s] / mass) if mass else 1.0

        def copies(k, u):
            return min(3, int(rate * k + u) - int(rate * (k - 1) + u))

        taken = [sum(n * copies(k, u) for k, (n, _) in enumerate(mine, 1)) for u in m.OFFSETS]
        u = m.OFFSETS[min(range(16), key=lambda j: (abs(taken[j] - goal[s]), j))]
        out.update({i: copies(k, u) for k, (_, i) in enumerate(mine, 1)})
    return out, goal


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_copies_and_caps(spark):
    rows = [(k, "w " * (k * 7919 % 97), ["a", "b", "é", None, "big"][k % 5 if k % 3 else 4]) for k in range(700)]
    rows += [(1000, "x y z", "tiny"), (1001, None, "empty"), (1002, "", "empty")]
    got = m.mix(frame(spark, rows)).collect()
    plain = [(i, len((t or "").split()), s) for i, t, s in rows]
    copies, goal = brute_mix(plain)
    source = {i: s for i, _, s in rows}
    assert {r["doc_id"]: r["copies"] for r in got} == copies
    taken = {}
    for r in got:
        s = source[r["doc_id"]]
        assert r["target"] == pytest.approx(goal[s])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["copies"]
        taken[s] = taken.get(s, 0) + r["taken"]
    largest = max(n for _, n, _ in plain)
    assert all(abs(taken[s] - goal[s]) <= largest / 2 for s in goal)


def test_sql_agrees(spark):
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
        want = c.execute(f"SELECT doc_id, size, source_size, round(target, 6), taken FROM ({m.ORACLE_OP1}) ORDER BY 1").fetchall()
    got = m.op1_mix_sources(spark, SF).select("doc_id", "size", "source_size", F.round("target", 6), "taken").orderBy("doc_id")
    assert [tuple(r) for r in got.collect()] == want


def test_newton_solves_two_families_of_constraints(spark):
    cells = spark.createDataFrame([("a", "x", 10.0), ("a", "y", 30.0), ("b", "x", 20.0), ("b", "y", 40.0)], "s string, l string, mass double")
    want = {"s": [("a", 60.0), ("b", 40.0)], "l": [("x", 35.0), ("y", 65.0)]}
    rated = m.balance(cells, {k: spark.createDataFrame(v, "g string, target double") for k, v in want.items()}, tolerance=1e-9)
    rows = rated.collect()
    for dim, goals in want.items():
        for g, target in goals:
            assert sum(r["mass"] * r["rate"] for r in rows if r[dim] == g) == pytest.approx(target, rel=1e-6)
    rate = {(r["s"], r["l"]): r["rate"] for r in rows}
    assert rate["a", "x"] * rate["b", "y"] == pytest.approx(rate["a", "y"] * rate["b", "x"], rel=1e-6)


def test_edges(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (1, "a b c", "s"), (None, "d e f", None), (None, None, None), (2, "", "t")]
    docs = frame(spark, rows).withColumn("target", F.lit("clash"))
    assert m.mix(docs).count() == len(rows)
    plan = m.mix(docs)
    taken = m.take(docs)
    assert taken.columns == docs.columns
    assert taken.count() == plan.agg(F.sum("copies")).first()[0]
    none = frame(spark, []).withColumn("x", F.lit(1))
    assert m.mix(none).count() == 0 and m.take(none).count() == 0


def test_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = sorted(map(tuple, m.mix(docs).collect()))
    assert a == sorted(map(tuple, m.mix(docs.repartition(7)).collect()))


def test_rows_that_share_an_id_get_the_copies_of_their_source_and_size(spark):
    rows = [(None if k % 3 else 7, " ".join([f"{s}{k}"] * (1 + k % 40)), s) for s in "abc" for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {r["source"]: (r["taken"], r["n"]) for r in m.planned(docs, "source", m.WEIGHTS, m.CAP).groupBy(
        F.expr("substring(g, 2)").alias("source")).agg(F.sum("taken").alias("taken"), F.sum("copies").alias("n")).collect()}
    taken = [sorted(map(tuple, m.take(d).collect()), key=str) for d in (docs, docs.repartition(5, "text"))]
    assert taken[0] == taken[1]
    assert {s: (sum(len(t.split()) for _, t, x in taken[0] if x == s), sum(x == s for *_, x in taken[0])) for s in "abc"} == want
