"""Scans along the timelines of keys that hold together however hot a key is.

A window over a key's rows in time order puts the whole key into one task.  Here a key
with more than ``rows_per_range`` rows has its timeline cut into ranges of whole days with
about that many rows; windows run inside a (key, range), and what a range needs to know
of earlier ones (a sum, the last version, the last time) is worked out from one row for
each range and carried into it.  Keys below the limit are one range and pay nothing but
the count that finds the hot ones.

The cuts are at most one row for each ``rows_per_range`` rows of the table and are
broadcast up to CUTS_AT_ONCE of them, counted first; beyond that they are joined by
shuffle.  Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.session import materialize

ROWS_PER_RANGE = 50_000
CUTS_AT_ONCE = 200_000
#: A scan over the whole table has so many ranges at least.
LEAST_RANGES = 8
RANGE = "_range"


def _attach(df: DataFrame, small: DataFrame, columns: Sequence[str], how: str = "left") -> DataFrame:
    """Null-safe join with a staged frame of known size."""
    renamed = small.select(*[F.col(c).alias(f"_r_{c}") for c in columns], *[c for c in small.columns if c not in columns])
    on = F.lit(True)
    for c in columns:
        on = on & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    side = F.broadcast(renamed) if small.count() <= CUTS_AT_ONCE else renamed
    joined = df.join(side, on, how)
    return joined if how == "left_semi" else joined.drop(*[f"_r_{c}" for c in columns])


class Cuts:
    """Where the timelines of hot keys are cut.

    With a key: one row (key, starts) for each hot key.  Without one the whole table is
    one hot key: one row (day, range) for each of its days, in at least LEAST_RANGES ranges.
    """

    def __init__(self, df: DataFrame, key: Sequence[str], at: str, rows_per_range: int = ROWS_PER_RANGE):
        self.key, self.at, self.frame = list(key), at, None
        rows = df.select(*key, at)
        if key:
            hot = materialize(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_range).select(*key))
            if hot.isEmpty():
                return
            rows = _attach(rows, hot, key, "left_semi")
        days = rows.groupBy(*key, F.to_date(at).alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
        # one row for each day of a hot key, however many rows the key has
        whole = Window.partitionBy(*key)
        earlier = whole.orderBy(F.asc_nulls_first("_day")).rowsBetween(Window.unboundedPreceding, -1)
        ranges = F.greatest(F.lit(1 if key else LEAST_RANGES), F.ceil(F.sum("_n").over(whole) / rows_per_range))
        number = F.floor(F.coalesce(F.sum("_n").over(earlier), F.lit(0)) * ranges / F.sum("_n").over(whole))
        days = days.withColumn(RANGE, number.cast("int"))
        if key:
            # the range of a day is the number of starts up to it, so numbers without a day of their own fall out
            starts = days.groupBy(*key, RANGE).agg(F.min("_day").alias("_day")).filter(F.col(RANGE) > 0)
            days = starts.groupBy(*key).agg(F.array_sort(F.collect_list("_day")).alias("_starts"))
        self.frame = materialize(days.drop("_n"))

    def ranged(self, df: DataFrame, at: Column | None = None) -> DataFrame:
        """``df`` with the number of the range that each row's time falls into (no time: the first)."""
        day = F.to_date(at if at is not None else F.col(self.at))
        if self.frame is None:
            return df.withColumn(RANGE, F.lit(0))
        if not self.key:
            return _attach(df.withColumn("_day", day), self.frame, ["_day"]).drop("_day")
        number = F.size(F.filter("_starts", lambda s: s <= day))
        return _attach(df, self.frame, self.key).withColumn(RANGE, F.greatest(F.coalesce(number, F.lit(0)), F.lit(0))).drop("_starts")

    def all_ranges(self) -> DataFrame | None:
        """(key, range) of hot keys, first range included."""
        if self.frame is None:
            return None
        if not self.key:
            return self.frame.select(RANGE).distinct()
        return self.frame.select(*self.key, F.explode(F.sequence(F.lit(0), F.size("_starts"))).alias(RANGE))


def running_sum(df: DataFrame, key: Sequence[str], at: str, tiebreak: Sequence[str], sums: dict[str, str],
                rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add running totals over raw rows: ``sums`` maps a new column to the column it adds up.

    Rows of a key go by ``at`` (none first), then ``tiebreak``, which makes the order total.
    Parallel prefix scan: sums of ranges, offsets of ranges, sums inside ranges.  NULLs add
    nothing; a total is NULL until the first value, as SUM() OVER is.  An empty ``key``
    runs over the whole table.
    """
    cuts = Cuts(df, key, at, rows_per_range)
    rows = cuts.ranged(df)
    inside = (Window.partitionBy(*key, RANGE).orderBy(F.asc_nulls_first(at), *tiebreak)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = rows.withColumns({name: F.sum(c).over(inside) for name, c in sums.items()})
    ranges = cuts.all_ranges()
    if ranges is None:
        return out.drop(RANGE)
    totals = rows.groupBy(*key, RANGE).agg(*[F.sum(c).alias(f"_s_{name}") for name, c in sums.items()])
    if key:
        totals = _attach(totals, cuts.frame.select(*key), key, "left_semi")
    earlier = Window.partitionBy(*key).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(totals.select(*key, RANGE, *[F.sum(f"_s_{name}").over(earlier).alias(f"_o_{name}") for name in sums]))
    out = _attach(out, offsets, [*key, RANGE])
    for name in sums:
        total = F.coalesce(name, F.lit(0)) + F.coalesce(f"_o_{name}", F.lit(0))
        out = out.withColumn(name, F.when(F.col(name).isNotNull() | F.col(f"_o_{name}").isNotNull(), total))
    return out.drop(RANGE, *[f"_o_{name}" for name in sums])


def as_of_join(facts: DataFrame, versions: DataFrame, key: Sequence[str], at: str, valid_from: str,
               columns: Sequence[str], valid_to: str | None = None, rows_per_range: int = ROWS_PER_RANGE,
               null_keys: bool = False) -> DataFrame:
    """Each fact with ``columns`` of the version of its key that is valid at its time.

    That is the version with the latest ``valid_from`` at or before ``at``; with
    ``valid_to``, NULLs once that version has ended.  Facts without key, time or version
    get NULLs; versions of one key must not begin together (the greatest counts).  Facts and
    versions are put in one order and the last version is carried forward, so the work
    is one sort of both; hot keys are cut into ranges, each of which starts with the
    version carried into it.
    """
    cuts = Cuts(facts, key, at, rows_per_range)
    fields = [c for c in facts.columns]
    version = F.struct(F.col(valid_from).alias("_from"), *([F.col(valid_to).alias("_to")] if valid_to else []),
                       *[F.col(c).alias(c) for c in columns])
    known = versions.filter(F.col(valid_from).isNotNull())
    for k in () if null_keys else key:
        known = known.filter(F.col(k).isNotNull())
    known = known.select(*key, F.col(valid_from).alias("_at"), version.alias("_v"))
    known = cuts.ranged(known, F.col("_at"))
    ranges = cuts.all_ranges()
    if ranges is not None:
        # one row for each range of a hot key: the last version of the ranges before
        last = known.groupBy(*key, RANGE).agg(F.max("_v").alias("_v"))
        every = _attach(ranges, materialize(last), [*key, RANGE])
        earlier = Window.partitionBy(*key).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        carried = every.select(*key, F.lit(None).cast(known.schema["_at"].dataType).alias("_at"),
                               F.last("_v", ignorenulls=True).over(earlier).alias("_v"), RANGE).filter("_v is not null")
        known = known.unionByName(carried)
    rows = cuts.ranged(facts).select(*key, F.col(at).cast(known.schema["_at"].dataType).alias("_at"), RANGE,
                                     F.struct(*fields).alias("_fact"))
    both = known.withColumn("_fact", F.lit(None).cast(rows.schema["_fact"].dataType)).unionByName(
        rows.withColumn("_v", F.lit(None).cast(known.schema["_v"].dataType)))
    # a carried version comes first, then by time; versions before facts of the same time
    order = Window.partitionBy(*key, RANGE).orderBy(
        F.asc_nulls_first("_at"), F.col("_fact").isNotNull(), "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_v", F.last("_v", ignorenulls=True).over(order)).filter("_fact is not null")
    valid = F.col("_v").isNotNull() & F.col("_at").isNotNull()
    if valid_to:
        valid = valid & (F.col("_v._to").isNull() | (F.col("_at") < F.col("_v._to")))
    return found.select(*[F.col(f"_fact.{c}").alias(c) for c in fields],
                        *[F.when(valid, F.col(f"_v.{c}")).alias(c) for c in columns])


def days_sum(df: DataFrame, key: Sequence[str], day: str, sums: dict[str, str], days: int) -> DataFrame:
    """Sums over the ``days`` calendar days up to each row's day (RANGE frame; days may be missing).

    ``df`` has one row for each key and day.  A window's sum is the running total at its
    last day less the running total as of the day before its first: two prefix sums,
    however wide the window is.
    """
    inner = {f"_p_{name}": c for name, c in sums.items()}
    running = materialize(running_sum(df, key, day, [], inner))
    before = running.select(*key, F.col(day).alias("_from"), *inner).withColumnsRenamed({n: f"_b{n}" for n in inner})
    probes = running.withColumn("_before", F.date_sub(F.col(day), days))
    found = as_of_join(probes, before, key, "_before", "_from", [f"_b{n}" for n in inner],
                       null_keys=True)
    for name in sums:
        n = f"_p_{name}"
        found = found.withColumn(name, F.coalesce(n, F.lit(0)) - F.coalesce(f"_b{n}", F.lit(0)))
    return found.drop("_before", *inner, *[f"_b{n}" for n in inner])


def sessions(events: DataFrame, user: str, at: str, tiebreak: Sequence[str], gap_minutes: int,
             rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``session_start``: a user's events belong together until ``gap_minutes`` pass without one.

    Events without user or time have no session and are filtered before any window.  The
    time of the event before a range's first is carried into it (the greatest time of the
    ranges before); so is the latest session start.
    """
    events = events.filter(F.col(user).isNotNull() & F.col(at).isNotNull())
    cuts = Cuts(events, [user], at, rows_per_range)
    rows = cuts.ranged(events)
    order = Window.partitionBy(user, RANGE).orderBy(at, *tiebreak)
    before = F.lag(at).over(order)
    ranges = cuts.all_ranges()
    earlier = Window.partitionBy(user).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)

    def carry(frame: DataFrame, value: Column, out: str) -> DataFrame:
        ends = frame.groupBy(user, RANGE).agg(F.max(value).alias("_last"))
        every = ranges.join(ends, [user, RANGE], "left")
        return _attach(frame, materialize(every.select(user, RANGE, F.max("_last").over(earlier).alias(out))), [user, RANGE])

    if ranges is not None:
        rows = carry(rows, F.col(at), "_carried")
        before = F.coalesce(before, F.col("_carried"))
    gap = F.expr(f"INTERVAL {int(gap_minutes)} MINUTES")
    rows = rows.withColumn("_before", before).withColumn(
        "_opens", F.when(F.col("_before").isNull() | (F.col(at) > F.col("_before") + gap), F.col(at)))
    start = F.last("_opens", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if ranges is not None:
        rows = carry(materialize(rows), F.col("_opens"), "_open")
        start = F.coalesce(start, F.col("_open"))
    return rows.withColumn("session_start", start).drop(RANGE, "_before", "_opens", "_carried", "_open")
