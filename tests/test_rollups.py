"""Kept sets of ids, quantiles by refinement and pairs by bounds, against plain Python."""

import datetime as dt
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tillsight.functions import distinct
from tillsight.functions.quantiles import quantiles
from tillsight.operators import rollups


@pytest.fixture(scope="module")
def rows():
    """A third of the rows in one group, a third without group; negative, repeated and missing ids."""
    rng = random.Random(3)
    groups = ["hot"] * 400 + [None] * 400 + [f"g{rng.randrange(20)}" for _ in range(400)]
    return [(g, dt.date(2024, 1 + n % 3, 1 + n % 28), None if n % 19 == 0 else rng.choice([-5, 63, 64, 2**40, rng.randrange(10**6)]))
            for n, g in enumerate(groups)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, d date, id long").repartition(7)


def test_sets_merge_upward(rows, frame):
    days = distinct.id_sets(frame, ["g", "d"], ["id"])
    got = {(r.g, r.d): r.id for r in distinct.set_sizes(days, ["g", "d"], ["id"]).collect()}
    want = {}
    for g, d, i in rows:
        if i is not None:
            want.setdefault((g, d), set()).add(i)
    assert got == {k: len(v) for k, v in want.items()}
    # two loads kept apart and put together later
    split = F.col("d") < F.lit(dt.date(2024, 2, 10))
    loads = distinct.id_sets(frame.filter(split), ["g", "d"], ["id"]).unionByName(distinct.id_sets(frame.filter(~split), ["g", "d"], ["id"]))
    months = distinct.merge_sets(loads, g=F.col("g"), m=F.trunc("d", "month"))
    groups = distinct.merge_sets(months, g=F.col("g"))
    assert {r.g: r.id for r in distinct.set_sizes(groups, ["g"], ["id"]).collect()} == {
        g: len({i for h, _, i in rows if h == g and i is not None}) for g in {r[0] for r in rows}}
    assert distinct.id_sets(frame.filter("false"), ["g"], ["id"]).count() == 0


def test_sketches_merge_within_their_error(spark):
    df = spark.range(40_000).select((F.col("id") % 10).alias("day"), F.concat(F.lit("s"), F.col("id") % 30_011).alias("session"))
    days = distinct.sketches(df, ["day"], "session")
    whole = distinct.merge_sketches(days, half=F.col("day") >= 5)
    whole = distinct.merge_sketches(whole, all=F.lit(1))
    assert abs(distinct.sketch_sizes(whole, ["all"], "n").first()["n"] / 30_011 - 1) < 0.04


@pytest.mark.parametrize("buckets", [2, 7, 1024])
def test_quantiles(rows, frame, buckets):
    fractions = {"least": (0, 1), "q1": (1, 4), "half": (1, 2), "third": (1, 3), "most": (1, 1)}
    got = {r.g: r for r in quantiles(frame, ["g"], "id", fractions, 100, buckets).collect()}
    assert set(got) == {r[0] for r in rows}
    for g, r in got.items():
        v = sorted(i for h, _, i in rows if h == g and i is not None)
        assert r.n == len(v)
        for name, (num, den) in fractions.items():
            at, rest = divmod(num * (len(v) - 1), den)
            want = (v[at] * den + (v[at + (rest > 0)] - v[at]) * rest) / (den * 100)
            assert r[name] == want
    assert quantiles(frame.filter("id IS NULL"), ["g"], "id", fractions).count() == 0


@pytest.mark.parametrize("first", [1, 3, 1000])
@pytest.mark.parametrize("k", [1, 7, 10_000])
def test_top_pairs_by_bounds(spark, first, k):
    rng = random.Random(4)
    lines = [(o, min(int(rng.expovariate(0.15)), 60)) for o in range(150) for _ in range(rng.randrange(1, 9))]
    lines += [(0, p) for p in range(40)] + [(None, 1), (None, 2), (5, None), (5, 3), (5, 3)]
    baskets = {}
    for o, p in lines:
        if o is not None and p is not None:
            baskets.setdefault(o, set()).add(p)
    counts = Counter(x for b in baskets.values() for x in combinations(sorted(b), 2))
    held = Counter(p for b in baskets.values() for p in b)
    want = sorted(((a, b, n, held[a], held[b]) for (a, b), n in counts.items()), key=lambda x: (-x[2], x[:2]))[:k]
    df = spark.createDataFrame(lines, "order_id long, product_key long").repartition(5)
    got = rollups.top_product_pairs(df, k, first).collect()
    assert [tuple(r)[:5] for r in got] == want


def test_bound_prunes_the_pairs(spark):
    """Products that cannot reach the bound are not paired, and an empty table has no pairs."""
    lines = [(o, p) for o in range(50) for p in (1, 2)] + [(o, 100 + o * 20 + p) for o in range(50) for p in range(20)]
    df = spark.createDataFrame(lines, "order_id long, product_key long")
    assert [tuple(r)[:3] for r in rollups.top_product_pairs(df, 1, 2).collect()] == [(1, 2, 50)]
    assert rollups.top_product_pairs(df.filter("false")).count() == 0
