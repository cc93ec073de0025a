"""Distributed NTILE / row numbers and exact half-up rounding."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillsight.functions.money import half_up
from tillsight.functions.ranking import with_global_row_number, with_ntile


@pytest.mark.parametrize("n,distinct,parts", [(0, 1, 3), (3, 3, 4), (7, 7, 3), (23, 2, 5),
                                              (101, 1, 4), (250, 40, 7)])
def test_ntile_matches_builtin(spark, n, distinct, parts):
    rnd = random.Random(n)
    data = [(i, rnd.randrange(distinct)) for i in range(n)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "k long, v long").repartition(3)
    ours = with_ntile(df, 5, [F.col("v").desc()], ["k"], out="t", num_partitions=parts)
    ref = df.withColumn("t", F.ntile(5).over(Window.orderBy(F.col("v").desc(), "k")))
    assert sorted(map(tuple, ours.select("k", "t").collect())) == \
        sorted(map(tuple, ref.select("k", F.col("t").cast("long")).collect()))


def test_row_number_independent_of_partitions(spark):
    data = [(i, (i * 7919) % 13) for i in range(500)]
    df = spark.createDataFrame(data, "k long, v long")
    expect = {k: i + 1 for i, (k, _) in enumerate(sorted(data, key=lambda r: (r[1], r[0])))}
    for parts in (1, 2, 9):
        got = dict(map(tuple, with_global_row_number(df, ["v"], ["k"], out="rn",
                                                     num_partitions=parts)
                       .select("k", "rn").collect()))
        assert got == expect


def _py_half_up(n: Decimal, d: Decimal, s: int):
    if d == 0:
        return None
    return float((n / d).quantize(Decimal(1).scaleb(-s), rounding=ROUND_HALF_UP))


def test_half_up_exact(spark):
    rnd = random.Random(7)
    cases = [(Decimal("1.25"), Decimal("1"), 1), (Decimal("-1.25"), Decimal("1"), 1),
             (Decimal("0"), Decimal("-3"), 1), (Decimal("5"), Decimal("0"), 1),
             (Decimal("2"), Decimal("3"), 0), (Decimal("1"), Decimal("8"), 2)]
    for _ in range(300):
        n = Decimal(rnd.randrange(-10**9, 10**9)).scaleb(-2)
        d = Decimal(rnd.randrange(1, 10**6)) * rnd.choice([1, -1])
        cases.append((n, d, rnd.choice([0, 1, 2])))
    df = spark.createDataFrame([(str(n), str(d), s) for n, d, s in cases], "n string, d string, s int")
    for s in (0, 1, 2):
        sub = df.filter(F.col("s") == s)
        got = sub.select("n", "d", half_up(F.col("n").cast("decimal(20,2)"),
                                           F.col("d").cast("decimal(20,2)"), s).alias("r")).collect()
        for row in got:
            exp = _py_half_up(Decimal(row.n), Decimal(row.d), s)
            assert row.r == exp, (row, exp)
            if exp == 0:
                assert str(row.r) == "0.0"  # never -0.0
