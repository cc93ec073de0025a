"""Global row numbers and NTILE without a single-partition sort.

``Window.orderBy(...)`` with no partition key moves the whole table into one
task.  Here the table is range-partitioned on the sort key plus a unique
tie-breaker (so even one hot value is split over many partitions), sorted
within partitions, and each row gets its position inside its partition.
That staged result is checkpointed to the reliable checkpoint folder: range
bounds come from sampling, so a recomputation could place rows differently,
and the positions must agree with the per-partition counts taken from it.
The counts (one row per partition) become running offsets, broadcast back
(their size is the partition count, never the data size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.session import materialize

_PART, _POS, _OFF, _TOTAL = "_ts_part", "_ts_pos", "_ts_off", "_ts_total"


def _sort_exprs(order: Sequence[Column | str], tiebreak: Sequence[str]) -> list[Column]:
    exprs = [F.col(c).asc() if isinstance(c, str) else c for c in order]
    return exprs + [F.col(c).asc() for c in tiebreak]


def with_global_row_number(df: DataFrame, order: Sequence[Column | str],
                           tiebreak: Sequence[str], out: str = "row_num",
                           num_partitions: int | None = None,
                           keep_total: str | None = None) -> DataFrame:
    """Add ``out``: 1-based position of each row in ``order`` then ``tiebreak``.

    ``tiebreak`` must make the order total (e.g. the table's key) so the
    numbering is deterministic.  ``keep_total`` names a column for the row
    count of the whole table (needed by NTILE).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _sort_exprs(order, tiebreak)
    staged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn(_PART, F.spark_partition_id())
        # lower 33 bits of the id = record number inside the partition
        .withColumn(_POS, F.monotonically_increasing_id()
                    - F.shiftleft(F.col(_PART).cast("long"), 33))
    )
    staged = materialize(staged)
    counts = staged.groupBy(_PART).agg(F.count(F.lit(1)).alias("_ts_n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        _PART,
        F.coalesce(F.sum("_ts_n").over(before), F.lit(0)).alias(_OFF),
        F.sum("_ts_n").over(Window.partitionBy()).alias(_TOTAL),
    )
    ranked = staged.join(F.broadcast(offsets), _PART).withColumn(
        out, F.col(_OFF) + F.col(_POS) + 1)
    if keep_total:
        ranked = ranked.withColumnRenamed(_TOTAL, keep_total)
    return ranked.drop(_PART, _POS, _OFF, _TOTAL)


def ntile_of(row_num: Column, total: Column, k: int) -> Column:
    """NTILE(k) bucket of a 1-based position among ``total`` rows.

    The first ``total % k`` buckets hold one extra row, as SQL's NTILE does.
    """
    q = F.floor(total / k).cast("long")
    r = (total - q * k).cast("long")
    big = r * (q + 1)
    first = F.floor((row_num - 1) / (q + 1))
    rest = r + F.floor((row_num - 1 - big) / F.greatest(q, F.lit(1)))
    return (F.when(row_num <= big, first).otherwise(rest) + 1).cast("long")


def with_ntile(df: DataFrame, k: int, order: Sequence[Column | str],
               tiebreak: Sequence[str], out: str,
               num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = NTILE(k) over ``order`` (+ ``tiebreak``), distributed."""
    ranked = with_global_row_number(df, order, tiebreak, out="_ts_rn",
                                    num_partitions=num_partitions,
                                    keep_total="_ts_cnt")
    return ranked.withColumn(out, ntile_of(F.col("_ts_rn"), F.col("_ts_cnt"), k)) \
                 .drop("_ts_rn", "_ts_cnt")


def tile_ends(df: DataFrame, k: int, value: str, tiebreak: str, descending: bool) -> list[tuple]:
    """Last (value, tiebreak) of each of the first k - 1 NTILE(k) tiles, in order.

    Only the two narrow columns are staged; k - 1 rows at most reach the driver.
    """
    column = F.col(value).desc() if descending else F.col(value).asc()
    placed = with_global_row_number(df.select(value, tiebreak), [column], [tiebreak], out="_ts_rn", keep_total="_ts_cnt")
    tile = ntile_of(F.col("_ts_rn"), F.col("_ts_cnt"), k)
    following = ntile_of(F.col("_ts_rn") + 1, F.col("_ts_cnt"), k)
    ends = placed.filter((F.col("_ts_rn") < F.col("_ts_cnt")) & (tile < following)).orderBy("_ts_rn")
    return [(r[value], r[tiebreak]) for r in ends.collect()]


def tile_label(ends: Sequence[tuple], value: str, tiebreak: str, descending: bool) -> Column:
    """NTILE of a row by comparison with the tile ends."""
    label = F.lit(1).cast("long")
    for end_value, end_key in ends:
        beyond = F.col(value) < F.lit(end_value) if descending else F.col(value) > F.lit(end_value)
        after = beyond | ((F.col(value) == F.lit(end_value)) & (F.col(tiebreak) > F.lit(end_key)))
        label = label + after.cast("long")
    return label
