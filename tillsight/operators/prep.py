"""Warehouse preparation: C1 calendar, C2 first-order flag, C3 SCD2 apply,
C5 surrogate keys."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions import calendar as cal
from tillsight.functions.ranking import with_global_row_number
from tillsight.session import materialize
from tillsight.sources.model import with_first_order_flag


def new_years_day(d: Column) -> Column:
    """Default holiday rule: 1 January of every year."""
    return (F.month(d) == 1) & (F.dayofmonth(d) == 1)


def dim_date_build(facts: DataFrame, date_col: str = "order_date",
                   holidays: Sequence[_dt.date] | None = None) -> DataFrame:
    """Dense calendar from the first to the last date of ``facts``.

    One global min/max aggregate, then ``sequence`` + ``explode``: the
    calendar's size is its day span, independent of the fact volume.
    ``holidays`` lists holiday dates; by default 1 January is a holiday.
    """
    bounds = facts.agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    days = bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY")))
                         .alias("_d"))
    d = F.col("_d")
    holiday = (d.isin(*holidays) if holidays is not None else new_years_day(d))
    return days.select(*cal.attributes(d), holiday.alias("is_holiday"))


def first_order_flag(orders: DataFrame) -> DataFrame:
    """``is_first_order`` on every order (earliest by date, then order id)."""
    return with_first_order_flag(orders)


def assign_surrogate_keys(ids: DataFrame, natural_key: str, key_col: str,
                          existing: DataFrame | None = None) -> DataFrame:
    """Stable integer keys for natural ids.

    Ids already in ``existing`` (columns natural_key, key_col) keep their
    key; new ids get max(existing key) + their position in natural-key
    order, numbered without a single-partition sort.  A NULL id gets no key.
    """
    new_ids = ids.select(natural_key).filter(F.col(natural_key).isNotNull()).distinct()
    start = 0
    if existing is not None:
        new_ids = new_ids.join(existing.select(natural_key), natural_key, "left_anti")
        # one scalar, the largest key in use
        start = existing.agg(F.max(key_col)).first()[0] or 0
    numbered = with_global_row_number(new_ids, [natural_key], [], out="_rn")
    fresh = numbered.select(natural_key, (F.col("_rn") + F.lit(start)).cast("long").alias(key_col))
    if existing is None:
        return fresh
    return existing.select(natural_key, F.col(key_col).cast("long")).unionByName(fresh)


def scd2_apply(dim: DataFrame, incoming: DataFrame, natural_key: str, surrogate_key: str,
               tracked: Sequence[str], effective: _dt.date) -> DataFrame:
    """Apply a snapshot of attribute values to a type-2 dimension.

    ``dim`` holds all versions (``effective_date``, ``expiry_date``,
    ``is_current``); ``incoming`` has one row per natural key with the
    tracked columns as of ``effective``.  A current version whose tracked
    values differ (null-safe; a change to NULL counts) is closed at ``effective``
    and a new version opens there (validity is half-open, so versions never
    overlap).  Natural keys new to the dimension get a first version.  New
    versions get keys above the largest key in use.

    Current versions and the snapshot meet in one full-outer join, whose rows
    become one or two output versions each and are staged; new versions are
    numbered from there.  Repeated natural keys in ``incoming``, or a change that
    takes effect before the version it closes began, raise ValueError.
    """
    doubled = incoming.groupBy(natural_key).count().filter("count > 1")
    if not doubled.isEmpty():
        raise ValueError(f"incoming repeats {natural_key}")
    current = dim.filter(F.col("is_current"))
    history = dim.filter(~F.col("is_current"))
    inc = incoming.select(natural_key, F.lit(True).alias("_given"), *[F.col(c).alias(f"_new_{c}") for c in tracked])
    j = current.withColumn("_known", F.lit(True)).join(inc, natural_key, "full_outer")
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    known, given = F.col("_known").isNotNull(), F.col("_given").isNotNull()
    changed = known & given & ~same
    types = {f.name: f.dataType for f in dim.schema.fields}

    def version(values: dict[str, Column], opens: bool) -> Column:
        return F.struct(*[values.get(c, F.col(c)).cast(types[c]).alias(c) for c in dim.columns],
                        F.lit(opens).alias("_opens"))

    old = version({"expiry_date": F.when(changed, F.lit(effective)).otherwise(F.col("expiry_date")),
                   "is_current": ~changed}, False)
    new = version({surrogate_key: F.lit(None), "effective_date": F.lit(effective), "expiry_date": F.lit(None),
                   "is_current": F.lit(True), **{c: F.col(f"_new_{c}") for c in tracked}}, True)
    both = F.array(F.when(known, old), F.when(changed | (given & ~known), new))
    early = changed & (F.col("effective_date") > F.lit(effective))
    versions = materialize(j.withColumn("_early", early).select(
        "_early", F.explode(F.filter(both, lambda v: v.isNotNull())).alias("v")).select("_early", "v.*"))
    if not versions.filter("_early").isEmpty():
        raise ValueError("a change takes effect before the version it closes")
    start = dim.agg(F.max(surrogate_key)).first()[0] or 0
    opened = with_global_row_number(versions.filter("_opens"), [natural_key], [], out="_rn").withColumn(
        surrogate_key, (F.col("_rn") + F.lit(start)).cast("long"))
    kept = versions.filter("not _opens")
    return history.unionByName(kept.select(*dim.columns)).unionByName(opened.select(*dim.columns))


def scd2_repair(dim: DataFrame, natural_key: str) -> DataFrame:
    """C3 companion: make a type-2 history non-overlapping.

    Versions of one natural key are ordered by (effective date, closed before
    current, expiry date, surrogate key); each version then starts no earlier
    than the previous one expires.  For the reference's sample, the current
    version of customer C001 starts 2024-04-01, where the expired one ends.
    The window groups one natural key's versions: one per applied change,
    so a group is bounded by the number of loads, not by the fact volume.
    """
    w = Window.partitionBy(natural_key).orderBy(
        F.col("effective_date"), F.col("is_current").asc(),
        F.col("expiry_date").asc_nulls_last(), F.col(dim.columns[0]))
    prev_end = F.max("expiry_date").over(w.rowsBetween(Window.unboundedPreceding, -1))
    start = F.when(prev_end.isNotNull() & (prev_end > F.col("effective_date")), prev_end) \
             .otherwise(F.col("effective_date"))
    return dim.withColumn("effective_date", start)
