"""Counts of pairs within groups, in tasks whose memory does not follow the input."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pairs that a task lists and counts, about.
PAIRS_AT_ONCE = 1 << 20
#: Large groups that are sent to all tasks (16 bytes each).
FEW_GROUPS = 1 << 18


class Deal:
    """How the pairs of ``rows``, one for each ``group`` and ``place``, are dealt to tasks.

    There are as many tasks as the pairs need at ``at_once`` each.  A group with more than
    that is dealt into blocks: each row is the first of its pairs in one block, by its
    place, and the second in all.
    """

    def __init__(self, rows: DataFrame, group: str, place: str, at_once: int = PAIRS_AT_ONCE):
        self.group, self.place = group, place
        n = F.col("n").cast("double")
        sizes = (rows.filter(F.col(group).isNotNull() & F.col(place).isNotNull()).groupBy(group)
                 .agg(F.count(F.lit(1)).alias("n")).withColumn("blocks", F.ceil(n * n / at_once).cast("long")))
        found = sizes.agg(F.sum(n * (n - 1) / 2).alias("pairs"), F.count_if(F.col("blocks") > 1).alias("large")).first()
        self.tasks = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil((found["pairs"] or 0) / at_once))
        self.large = None
        if found["large"]:
            large = sizes.filter("blocks > 1").select(group, "blocks")
            self.large = F.broadcast(large) if found["large"] <= FEW_GROUPS else large

    def sides(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``rows`` as first and as second of pairs, dealt by group and block."""
        if self.large is None:
            dealt = rows.repartition(self.tasks, self.group)
            return dealt, dealt
        one = F.lit(1).cast("long")
        rows = rows.join(self.large, self.group, "left").withColumn("blocks", F.coalesce("blocks", one))
        first = rows.withColumn("block", F.pmod(F.xxhash64(self.place), F.col("blocks")) + 1)
        second = rows.withColumn("block", F.explode(F.sequence(one, F.col("blocks"))))
        return tuple(side.drop("blocks").repartition(self.tasks, self.group, "block") for side in (first, second))


def counted_pairs(rows: DataFrame, deal: Deal, key: str, weight: str | None = None) -> DataFrame:
    """(key_a, key_b, n): pairs in one group, the first with the smaller place, counted by key.

    A pair counts once, or the product of both weights.  A task sums its pairs before they
    are shuffled, so a pair that most groups hold costs a row for each task.
    """
    first, second = deal.sides(rows)
    a, b = first.alias("a"), second.alias("b")
    together = F.col(f"a.{deal.place}") < F.col(f"b.{deal.place}")
    for c in (deal.group, "block") if deal.large is not None else (deal.group,):
        together &= F.col(f"a.{c}") == F.col(f"b.{c}")
    n = F.sum(F.col(f"a.{weight}") * F.col(f"b.{weight}")) if weight else F.count(F.lit(1))
    return a.join(b, together).groupBy(F.col(f"a.{key}").alias(f"{key}_a"), F.col(f"b.{key}").alias(f"{key}_b")).agg(n.alias("n"))
