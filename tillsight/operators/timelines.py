"""Questions about time: values valid then, windows after an event, histories, running totals, sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions import timeline
from tillsight.functions.money import avg_money, half_up
from tillsight.operators import funnel
from tillsight.operators.common import COMPLETED, dated, with_status

#: A bucket of a band join with more points than this is dealt to several tasks.
POINTS_PER_GROUP = 50_000


def history_from_changes(changes: DataFrame, key: str, tracked: Sequence[str], at: str, sequence: str) -> DataFrame:
    """Type-2 history from a feed with many changes for each key, in any order of arrival.

    Of a key's changes that take effect on one day the one with the greatest
    ``sequence`` counts; neighbours with equal values are one version (gaps and islands).
    Versions are half-open: the next one begins where one ends; the last is open.
    Changes are first reduced to one for each key and day (combined before the shuffle),
    so a key's window is bounded by the calendar.  Returns key, version (from 1), the
    tracked columns, effective_date, expiry_date, is_current.
    """
    given = changes.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
    days = given.groupBy(key, F.to_date(at).alias("effective_date")).agg(
        F.max(F.struct(F.col(sequence).alias("_s"), F.struct(*tracked).alias("_v"))).alias("_c")).select(
        key, "effective_date", F.col("_c._v").alias("_v"))
    own = Window.partitionBy(key).orderBy("effective_date")
    first = F.row_number().over(own) == 1
    kept = days.withColumn("_opens", first | ~F.lag("_v").over(own).eqNullSafe(F.col("_v"))).filter("_opens")
    expiry = F.lead("effective_date").over(own)
    return kept.select(key, F.row_number().over(own).cast("long").alias("version"), *[F.col(f"_v.{c}").alias(c) for c in tracked],
                       "effective_date", expiry.alias("expiry_date"), expiry.isNull().alias("is_current"))


def merge_changes(history: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], at: str, sequence: str) -> DataFrame:
    """A stored history with more changes, late ones included (they part or shorten stored versions).

    Only keys with changes are worked out anew; a stored version counts as a change that
    came before all new ones.  A late change holds until the key's next version: that the
    feed had once repeated the old value in between is not known to a stored history.
    ``history`` is a result of ``history_from_changes``.
    """
    given = changes.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
    touched = given.select(key).distinct()
    stored = history.join(touched, key, "left_semi").select(
        key, *tracked, F.col("effective_date").alias(at), F.lit(None).cast(changes.schema[sequence].dataType).alias(sequence))
    anew = history_from_changes(stored.unionByName(given.select(key, *tracked, F.to_date(at).alias(at), sequence)),
                                key, tracked, at, sequence)
    return history.join(touched, key, "left_anti").unionByName(anew.select(history.columns))


def revenue_by_value_at_order(orders: DataFrame, history: DataFrame, key: str, column: str, status: str | None = COMPLETED) -> DataFrame:
    """Orders and revenue by the value of ``column`` that was valid on the order date.

    Orders are summed by key and day before the as-of join.
    """
    daily = dated(with_status(orders, status)).groupBy(key, "order_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("net_revenue").alias("revenue"), F.count("net_revenue").alias("paid"))
    found = timeline.as_of_join(daily, history, [key], "order_date", "effective_date", [column], valid_to="expiry_date")
    sums = found.groupBy(column).agg(F.sum("n").cast("long").alias("orders"), F.sum("revenue").alias("_revenue"), F.sum("paid").alias("_paid"),
                                     F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"))
    return sums.select(column, "orders", F.col("_revenue").cast("double").alias("revenue"),
                       avg_money(F.col("_revenue"), F.col("_paid")).alias("avg_order_value"), "first_order_date", "last_order_date")


def band_join(points: DataFrame, bands: DataFrame, key: Sequence[str], at: str, start: str, end: str,
              width_days: int = 30, points_per_group: int = POINTS_PER_GROUP) -> DataFrame:
    """Pairs of a point and a band with equal ``key`` and ``start <= at <= end`` (days, both included).

    Days fall into buckets of ``width_days``; a band is repeated for each bucket it
    touches, and points meet bands by an equality of key and bucket with the exact test
    beside it.  So the join never compares a point with bands of other times, also
    without a key.  A bucket with more than ``points_per_group`` points is dealt out by a
    hash of the whole point, and its bands are repeated for each part.  Columns of both
    sides are kept, ``key`` once; names must not clash.
    """
    def bucket(c: str):
        return F.floor(F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) / width_days)

    whole = [F.col(k).isNotNull() for k in key]
    points = points.filter(F.col(at).isNotNull()).withColumn("_bucket", bucket(at))
    bands = bands.filter((F.col(start) <= F.col(end))).withColumn("_bucket", F.explode(F.sequence(bucket(start), bucket(end))))
    for known in whole:
        points, bands = points.filter(known), bands.filter(known)
    group = [*key, "_bucket"]
    hot = timeline.materialize(points.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > points_per_group)
                               .select(*group, F.ceil(F.col("_n") / points_per_group).cast("int").alias("_parts")))
    if hot.isEmpty():
        points, bands = points.withColumn("_part", F.lit(0)), bands.withColumn("_part", F.lit(0))
    else:
        parts = F.coalesce("_parts", F.lit(1))
        columns = [c for c in points.columns if c != "_bucket"]
        points = timeline._attach(points, hot, group).withColumn("_part", F.pmod(F.xxhash64(*columns), parts).cast("int"))
        bands = timeline._attach(bands, hot, group).withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    joined = points.drop("_parts").join(bands.drop("_parts"), [*group, "_part"])
    return joined.filter((F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end))).drop("_bucket", "_part")


def orders_after_first(orders: DataFrame, windows: Sequence[int] = (30, 60, 90), status: str | None = COMPLETED) -> DataFrame:
    """For each window: customers with an order, those who order again within so many days
    after their first order day, and the number and revenue of those orders."""
    daily = dated(with_status(orders, status)).filter("customer_key is not null").groupBy("customer_key", "order_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("net_revenue").alias("revenue"))
    daily = timeline.materialize(daily)
    firsts = daily.groupBy("customer_key").agg(F.min("order_date").alias("_first"))
    bands = firsts.withColumn("window_days", F.explode(F.array(*map(F.lit, windows)))).select(
        "customer_key", "window_days", F.date_add("_first", 1).alias("_start"), F.expr("date_add(_first, window_days)").alias("_end"))
    met = band_join(daily, bands, ["customer_key"], "order_date", "_start", "_end")
    each = met.groupBy("window_days", "customer_key").agg(F.sum("n").alias("n"), F.sum("revenue").alias("revenue"))
    sums = each.groupBy("window_days").agg(F.count(F.lit(1)).alias("a"), F.sum("n").alias("n"), F.sum("revenue").alias("revenue"))
    # bands give each window's customers, so windows without an order are listed too
    people = bands.groupBy("window_days").agg(F.count(F.lit(1)).alias("total_customers"))
    return people.join(sums, "window_days", "left").select(
        F.col("window_days").cast("long").alias("window_days"), "total_customers",
        F.coalesce("a", F.lit(0)).alias("returning_customers"), F.coalesce("n", F.lit(0)).alias("orders"),
        F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("revenue")).orderBy("window_days")


def running_revenue(orders: DataFrame, status: str | None = COMPLETED, rows_per_range: int = timeline.ROWS_PER_RANGE) -> DataFrame:
    """Every order with its customer's running revenue and order number, and the whole table's running
    revenue, by date and order key."""
    rows = dated(with_status(orders, status)).select("order_key", "customer_key", "order_date", "net_revenue").withColumn(
        "_one", F.lit(1).cast("long"))
    rows = timeline.running_sum(rows, ["customer_key"], "order_date", ["order_key"],
                                {"customer_revenue": "net_revenue", "customer_orders": "_one"}, rows_per_range)
    rows = timeline.running_sum(rows, [], "order_date", ["order_key"], {"total_revenue": "net_revenue"}, rows_per_range)
    return rows.select("order_key", "customer_key", "order_date", F.col("net_revenue").cast("double").alias("net_revenue"),
                       F.col("customer_revenue").cast("double").alias("customer_revenue"),
                       F.col("customer_orders").cast("long").alias("customer_orders"),
                       F.col("total_revenue").cast("double").alias("total_revenue"))


def revenue_last_days(orders: DataFrame, key: str = "channel_key", days: int = 7, status: str | None = COMPLETED) -> DataFrame:
    """By key and day with orders: revenue, and sums and the mean over the last ``days`` calendar days."""
    daily = dated(with_status(orders, status)).groupBy(key, "order_date").agg(
        F.sum("net_revenue").alias("_revenue"), F.count(F.lit(1)).alias("_orders")).withColumn("_one", F.lit(1).cast("long"))
    found = timeline.days_sum(daily, [key], "order_date", {"_sum": "_revenue", "_n": "_orders", "_days": "_one"}, days)
    return found.select(key, "order_date", F.col("_revenue").cast("double").alias("revenue"),
                        F.col("_sum").cast("double").alias("revenue_last_days"), F.col("_n").cast("long").alias("orders_last_days"),
                        F.col("_days").cast("long").alias("days_with_orders"),
                        half_up(F.col("_sum"), F.col("_days"), 2).alias("avg_daily_revenue"))


def session_funnel(events: DataFrame, gap_minutes: int = 720, rows_per_range: int = timeline.ROWS_PER_RANGE) -> DataFrame:
    """The ordered funnel over sessions that end after ``gap_minutes`` without an event of the user."""
    found = timeline.sessions(events, "customer_key", "event_ts", ["event_key"], gap_minutes, rows_per_range)
    session = F.concat_ws("-", F.col("customer_key").cast("string"), F.col("session_start").cast("string"))
    return funnel.funnel_sessions(found.withColumn("session_id", session))
