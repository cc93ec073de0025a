"""Exact quantiles of groups without sorting a group.

The value at a rank is found by zooming in: values between a group's least and greatest
are counted in equal ranges, the range that holds the rank is cut up again, until a
range is one value.  A round is a scan of two narrow columns with counts combined before the
shuffle, so a group with all rows of the table is no more work for a task than any other.
Values spread over R integers need log(R) / log(BUCKETS) rounds: 3 for a thousand million.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.timeline import CUTS_AT_ONCE
from tillsight.session import materialize

BUCKETS = 1024


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]):
    on = F.lit(True)
    for c in columns:
        on = on & left[c].eqNullSafe(right[f"_r{c}"])
    return on


def _renamed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"_r{c}" for c in columns})


def values_at_ranks(rows: DataFrame, key: Sequence[str], ranks: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(key, _rank, _value)`` for ``ranks(key, _rank, _lo, _hi)``: ranks from 0, group's least and greatest value.

    ``rows`` has the key and a long ``_v`` without NULLs.  NULL keys are a group.
    """
    targets = materialize(ranks.withColumn("_below", F.lit(0).cast("long")))
    while True:
        # ranges of one group are equal or disjoint, so a row falls into one at most
        ranges = materialize(targets.filter("_lo < _hi").select(*key, "_lo", "_hi").distinct())
        n = ranges.count()
        if n == 0:
            return targets.select(*key, "_rank", F.col("_lo").alias("_value"))
        side = _renamed(ranges, key)
        side = F.broadcast(side) if n <= CUTS_AT_ONCE else side
        width = F.expr(f"(_hi - _lo) DIV {buckets} + 1")
        met = rows.join(side, _same(rows, side, key) & F.col("_v").between(F.col("_lo"), F.col("_hi")))
        counts = (met.withColumn("_width", width).groupBy(*key, "_lo", "_hi", F.expr("(_v - _lo) DIV _width").alias("_bucket"), "_width")
                  .agg(F.count(F.lit(1)).alias("_n")))
        upto = Window.partitionBy(*key, "_lo", "_hi").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = counts.withColumn("_upto", F.sum("_n").over(upto))
        cut = _renamed(counts, [*key, "_lo", "_hi"])
        place = F.col("_rank") - F.col("_below")
        found = targets.join(cut, _same(targets, cut, [*key, "_lo", "_hi"]) & (place < F.col("_upto")) & (place >= F.col("_upto") - F.col("_n")))
        low = F.col("_lo") + F.col("_bucket") * F.col("_width")
        found = found.select(*key, "_rank", low.alias("_lo"), F.least(F.col("_hi"), low + F.col("_width") - 1).alias("_hi"),
                             (F.col("_below") + F.col("_upto") - F.col("_n")).alias("_below"))
        targets = materialize(targets.filter("_lo = _hi").select(found.columns).unionByName(found))


def quantiles(df: DataFrame, key: Sequence[str], value: str, fractions: dict[str, tuple[int, int]],
              scale: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """By key: ``n`` values and the quantiles ``fractions`` (name to (numerator, denominator)) as doubles.

    ``value`` is a whole number within 2^61 of 0 (money in cents with ``scale`` 100); NULLs are
    left out and groups of NULLs not listed.  A quantile between two values is interpolated
    between them, exactly but for the last division.  ``key`` must not be empty.
    """
    rows = materialize(df.filter(F.col(value).isNotNull()).select(*key, F.col(value).cast("long").alias("_v")))
    spans = materialize(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")))
    at = {name: (f"({num} * (n - 1)) DIV {den}", f"({num} * (n - 1)) % {den}") for name, (num, den) in fractions.items()}
    wanted = F.array_distinct(F.array(*[F.expr(x) for low, rest in at.values() for x in (low, f"{low} + if({rest} > 0, 1, 0)")]))
    found = values_at_ranks(rows, key, spans.select(*key, F.explode(wanted).alias("_rank"), "_lo", "_hi"), buckets)
    # a handful of values for each group
    each = found.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))
    side = _renamed(each, key)
    joined = spans.join(side, _same(spans, side, key))
    out = [(F.expr(f"_at[{low}] * {den} + (_at[{low} + if({rest} > 0, 1, 0)] - _at[{low}]) * ({rest})") / F.lit(float(den * scale))).alias(name)
           for (name, (low, rest)), (_, den) in zip(at.items(), fractions.values())]
    return joined.select(*key, "n", *out)
