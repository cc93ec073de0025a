"""Pairs within groups are counted whole, however they are dealt to tasks."""

import re
from collections import Counter
from itertools import combinations

import pytest

from tillsight.functions import pairs
from tillsight.operators import affinity, rollups


@pytest.fixture(scope="module")
def rows():
    """One group with 60 places, 50 small ones, one without number, and rows without place."""
    found = [(1, p, 1 + p % 3) for p in range(60)] + [(g, (g * k) % 61, k) for g in range(2, 52) for k in range(1, 6)]
    return found + [(None, p, 1) for p in range(9)] + [(1, None, 1), (7, None, 2)]


@pytest.mark.parametrize("at_once", [5, 100, 1 << 20])
def test_dealt_pairs_are_counted_whole(spark, monkeypatch, rows, at_once):
    monkeypatch.setattr(pairs, "FEW_GROUPS", 0 if at_once == 5 else 1 << 18)
    df = spark.createDataFrame(rows, "g long, p long, n long").repartition(3)
    deal = pairs.Deal(df, "g", "p", at_once)
    whole = [r for r in rows if None not in r]
    sizes = Counter(r[0] for r in whole)
    assert deal.tasks >= sum(n * (n - 1) // 2 for n in sizes.values()) / at_once
    assert (deal.large is None) == (at_once == 1 << 20)
    if deal.large is not None:
        assert {r.g for r in deal.large.collect()} == {g for g, n in sizes.items() if n * n > at_once}
    times, weighed = Counter(), Counter()
    for g in sizes:
        for (a, n), (b, m) in combinations(sorted((p, n) for h, p, n in whole if h == g), 2):
            if a < b:
                times[a, b] += 1
                weighed[a, b] += n * m
    assert {(r.p_a, r.p_b): r.n for r in pairs.counted_pairs(df, deal, "p").collect()} == times
    assert {(r.p_a, r.p_b): r.n for r in pairs.counted_pairs(df, deal, "p", "n").collect()} == weighed


@pytest.mark.parametrize("query", ["affinity", "top pairs"])
def test_tasks_follow_the_number_of_pairs(spark, monkeypatch, query):
    """More pairs, more tasks that list them: the session's number of partitions is no limit."""
    seen = []
    sides = pairs.Deal.sides
    monkeypatch.setattr(pairs.Deal.__init__, "__defaults__", (20,))
    monkeypatch.setattr(pairs.Deal, "sides", lambda deal, df: seen.append(sides(deal, df)) or seen[-1])
    lines = spark.createDataFrame([(o, (o * k) % 97) for o in range(1, 200) for k in range(1, 7)], "order_id long, product_key long")
    if query == "affinity":
        names = spark.createDataFrame([(p, f"name {p}") for p in range(97)], "product_key long, product_name string")
        assert affinity.product_affinity(lines, names).count() == 15
    else:
        assert rollups.top_product_pairs(lines).count() == 20
    for first, second in seen:
        for side in (first, second):
            plan = side._jdf.queryExecution().executedPlan().toString()
            assert max(map(int, re.findall(r"hashpartitioning\([^)]*, (\d+)\), REPARTITION_BY_NUM", plan))) >= 100
    assert seen
