"""Scans along timelines against plain Python, with a hot key cut into many ranges."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillsight.functions import timeline
from tillsight.operators import timelines

DAY0 = dt.date(2024, 1, 1)


def day(k):
    return None if k is None else DAY0 + dt.timedelta(days=k)


@pytest.fixture(scope="module")
def rows():
    """A third of all rows on key 7, a third without key; missing days, ties, NULL values and dates."""
    rng = random.Random(1)
    keys = [7] * 300 + [None] * 300 + [rng.randrange(20, 60) for _ in range(300)]
    return [(n, k, day(rng.choice([None, *range(0, 90)]) if n % 50 == 0 else rng.randrange(0, 90)),
             None if n % 17 == 0 else Decimal(rng.randrange(-500, 500)) / 100) for n, k in enumerate(keys)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, k long, d date, v decimal(18,2)").repartition(5)


@pytest.mark.parametrize("limit", [10, 10**6])
@pytest.mark.parametrize("key", [["k"], []])
def test_running_sum(rows, frame, limit, key):
    got = {r["id"]: r["total"] for r in timeline.running_sum(frame, key, "d", ["id"], {"total": "v"}, limit).collect()}
    want, sums = {}, {}
    for n, k, d, v in sorted(rows, key=lambda r: (r[2] is not None, r[2] or DAY0, r[0])):
        g = k if key else 0
        if v is not None:
            sums[g] = sums.get(g, 0) + v
        want[n] = sums.get(g)
    assert got == want


def test_hot_key_is_cut(frame):
    cuts = timeline.Cuts(frame, ["k"], "d", 30)
    sizes = cuts.ranged(frame).groupBy("k", timeline.RANGE).count().collect()
    assert max(r["count"] for r in sizes) <= 60  # a third of the rows in one key, 300 each
    assert {r["k"] for r in cuts.frame.collect()} == {7, None}


@pytest.mark.parametrize("limit", [10, 10**6])
@pytest.mark.parametrize("ends", [False, True])
def test_as_of_join(spark, rows, frame, limit, ends):
    rng = random.Random(2)
    versions = {}
    for k in [7, 21, 22, 30, None]:
        for _ in range(12 if k == 7 else 3):
            d = rng.randrange(-10, 95)
            versions[k, d] = (k, day(d), day(d + rng.randrange(1, 30)), rng.choice(["a", "b", None]))
    table = list(versions.values())
    vf = spark.createDataFrame(table, "k long, since date, until date, name string")
    got = timeline.as_of_join(frame, vf, ["k"], "d", "since", ["name"], "until" if ends else None, limit)
    assert got.columns == ["id", "k", "d", "v", "name"]

    def value(k, d):
        mine = [v for v in table if v[0] is not None and v[0] == k and d is not None and v[1] <= d]
        last = max(mine, key=lambda v: v[1], default=None)
        return None if last is None or ends and d >= last[2] else last[3]

    assert {r["id"]: r["name"] for r in got.collect()} == {n: value(k, d) for n, k, d, _ in rows}


@pytest.mark.parametrize("days", [1, 7, 40])
def test_days_sum(frame, days):
    daily = frame.filter("d is not null").groupBy("k", "d").agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    got = timeline.days_sum(daily, ["k"], "d", {"sv": "v", "sn": "n"}, days).collect()
    table = daily.collect()
    for r in got:
        mine = [x for x in table if x["k"] == r["k"] and r["d"] - dt.timedelta(days=days) < x["d"] <= r["d"]]
        assert (r["sv"], r["sn"]) == (sum(x["v"] or 0 for x in mine), sum(x["n"] for x in mine))
    assert len(got) == len(table)


@pytest.mark.parametrize("limit", [10, 10**6])
def test_band_join(rows, spark, frame, limit):
    rng = random.Random(3)
    bands = [(b, rng.choice([7, 21, 25, None]), day(a := rng.randrange(-5, 90)), day(a + rng.randrange(-1, 50))) for b in range(40)]
    bf = spark.createDataFrame(bands, "b int, k long, lo date, hi date")
    for key in (["k"], []):
        got = timelines.band_join(frame, bf if key else bf.drop("k"), key, "d", "lo", "hi", 7, limit)
        pairs = sorted((r["id"], r["b"]) for r in got.collect())
        assert pairs == sorted((n, b) for n, k, d, _ in rows for b, bk, lo, hi in bands
                               if d is not None and lo <= d <= hi and (not key or k is not None and k == bk))


@pytest.mark.parametrize("limit", [10, 10**6])
def test_sessions(spark, limit):
    rng = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    events = [(n, rng.choice([1, 1, 2, 3, None]), t0 + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 9, 5))) for n in range(400)]
    events += [(1000 + n, 1, t0 + dt.timedelta(minutes=30 * n)) for n in range(200)] + [(5000, 2, None)]
    frame = spark.createDataFrame(events, "id long, u long, ts timestamp_ntz").repartition(4)
    got = {r["id"]: r["session_start"] for r in timeline.sessions(frame, "u", "ts", ["id"], 30, limit).collect()}
    want, last, start = {}, {}, {}
    for n, u, ts in sorted((e for e in events if e[1] is not None and e[2] is not None), key=lambda e: (e[2], e[0])):
        if u not in last or ts - last[u] > dt.timedelta(minutes=30):
            start[u] = ts
        last[u] = ts
        want[n] = start[u]
    assert got == want


def _history(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def plain_history(feed):
    """Versions of (key, value, day, sequence) changes."""
    want = []
    for k in sorted({f[0] for f in feed if f[0] is not None}):
        by_day = {}
        for _, c, d, _ in sorted((f for f in feed if f[0] == k and f[2] is not None), key=lambda f: f[3]):
            by_day[d] = c
        kept = []
        for d in sorted(by_day):
            if not kept or kept[-1][1] != by_day[d]:
                kept.append((d, by_day[d]))
        ends = [d for d, _ in kept[1:]] + [None]
        want += [(k, n + 1, c, d, e, e is None) for n, ((d, c), e) in enumerate(zip(kept, ends))]
    return want


def test_history_from_late_changes(spark):
    rng = random.Random(5)
    feed = [(rng.choice([1, 2, 3, 4]), rng.choice(["x", "y", None]), day(rng.randrange(0, 12)), n) for n in range(60)]
    feed += [(5, "x", day(3), 100), (None, "x", day(1), 101), (6, "x", None, 102), (5, "x", day(4), 103), (5, "x", day(4), 99)]
    schema = "k long, c string, d date, s long"
    whole = timelines.history_from_changes(spark.createDataFrame(feed, schema), "k", ["c"], "d", "s")
    assert _history(whole.collect()) == _history(plain_history(feed))
    # half of the feed first, the rest (with earlier days too) merged later; key 5 comes in the second half only
    first = timelines.history_from_changes(spark.createDataFrame(feed[:30], schema), "k", ["c"], "d", "s")
    merged = timelines.merge_changes(first, spark.createDataFrame(feed[30:], schema), "k", ["c"], "d", "s")
    stored = [(k, c, d, -1) for k, _, c, d, _, _ in plain_history(feed[:30])]
    assert _history(merged.collect()) == _history(plain_history(stored + feed[30:]))


def test_merge_leaves_other_keys(spark):
    schema = "k long, c string, d date, s long"
    first = timelines.history_from_changes(spark.createDataFrame([(1, "a", day(0), 1), (2, "b", day(0), 2)], schema), "k", ["c"], "d", "s")
    merged = timelines.merge_changes(first, spark.createDataFrame([(1, "z", day(-5), 9)], schema), "k", ["c"], "d", "s")
    assert _history(merged.collect()) == _history([(1, 1, "z", day(-5), day(0), False), (1, 2, "a", day(0), None, True),
                                                   (2, 1, "b", day(0), None, True)])


def test_empty(spark):
    none = spark.createDataFrame([], "id long, k long, d date, v decimal(18,2)")
    assert timeline.running_sum(none, ["k"], "d", ["id"], {"t": "v"}).collect() == []
    assert timeline.running_sum(none, [], "d", ["id"], {"t": "v"}).collect() == []
    assert timeline.as_of_join(none, none.select("k", "d", F.col("v").alias("w")).withColumnRenamed("d", "f"), ["k"], "d", "f", ["w"]).collect() == []
