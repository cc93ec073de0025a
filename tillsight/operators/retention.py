"""Cohorts and retention: A7 cohort retention, A8 cohort matrix, A9 30/60/90-day retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight import constants as C
from tillsight.functions import calendar as cal
from tillsight.functions.money import pct
from tillsight.operators.common import COMPLETED, dated, first_two_order_days


def cohort_activity(orders: DataFrame, status: str = COMPLETED) -> DataFrame:
    """(cohort month, months since first) -> active users, with cohort size.

    The cohort of a customer is the month of their earliest order flagged
    ``is_first_order``; activity counts customers with a qualifying order in
    a month.  Orders collapse to (customer, month) first (map-side partial
    aggregation: a customer's group is bounded by the calendar), the cohort
    month spreads over that small table with a window per customer, and one
    aggregation yields both the activity counts and the cohort sizes (the
    month-0 rows), so nothing is scanned or joined twice.
    """
    month = F.trunc(F.col("order_date"), "MM")
    cm = dated(orders).filter(F.col("customer_key").isNotNull()).groupBy("customer_key", month.alias("activity_month")).agg(
        F.max(F.col("order_status") == status).alias("active"),
        F.max(F.col("is_first_order")).alias("has_first"),
    )
    per_customer = Window.partitionBy("customer_key")
    cm = cm.withColumn(
        "cohort_month_date",
        F.min(F.when(F.col("has_first"), F.col("activity_month"))).over(per_customer),
    ).filter(F.col("cohort_month_date").isNotNull())
    k = cal.month_index(F.col("activity_month")) - cal.month_index(F.col("cohort_month_date"))
    g = cm.groupBy("cohort_month_date", k.alias("months_since_first")).agg(
        F.count_if(F.col("active")).alias("active_users"),
        F.count(F.lit(1)).alias("_rows"),
    )
    # cohort size = customers whose cohort month row exists = rows at k == 0;
    # the window runs over the (cohorts x months) result only.
    per_cohort = Window.partitionBy("cohort_month_date")
    size = F.sum(F.when(F.col("months_since_first") == 0, F.col("_rows"))).over(per_cohort)
    return g.withColumn("cohort_users", F.coalesce(size, F.lit(0)).cast("long")).drop("_rows")


def cohort_retention(orders: DataFrame, status: str = COMPLETED) -> DataFrame:
    """One row per (cohort, month offset) with qualifying activity."""
    a = cohort_activity(orders, status).filter(F.col("active_users") > 0)
    return a.select(
        cal.year_month(F.col("cohort_month_date")).alias("cohort_month"),
        "cohort_users",
        F.col("months_since_first").cast("long").alias("months_since_first"),
        F.col("active_users").cast("long").alias("active_users"),
        pct(F.col("active_users"), F.col("cohort_users"), 1).alias("retention_pct"),
    ).orderBy("cohort_month", "months_since_first")


def cohort_matrix(orders: DataFrame, status: str = COMPLETED,
                  months: int = C.COHORT_MONTHS) -> DataFrame:
    """Pivot of A7 - month 0 as a count, months 1..n as whole percents.

    Cohorts appear when they have any qualifying activity; offsets beyond
    ``months`` are not shown.
    """
    a = cohort_activity(orders, status)
    k = F.col("months_since_first")
    aggs = [F.max("cohort_users").alias("cohort_users"),
            F.sum("active_users").alias("_any"),
            F.coalesce(F.sum(F.when(k == 0, F.col("active_users"))), F.lit(0)).cast("long").alias("m0")]
    for i in range(1, months + 1):
        aggs.append(F.coalesce(F.sum(F.when(k == i, F.col("active_users"))), F.lit(0))
                    .alias(f"_m{i}"))
    g = a.groupBy("cohort_month_date").agg(*aggs).filter(F.col("_any") > 0)
    cols = [cal.year_month(F.col("cohort_month_date")).alias("cohort_month"),
            "cohort_users", "m0"]
    cols += [pct(F.col(f"_m{i}"), F.col("cohort_users"), 0).alias(f"m{i}_pct")
             for i in range(1, months + 1)]
    return g.select(*cols).orderBy("cohort_month")


def day_retention(orders: DataFrame, status: str = COMPLETED,
                  windows: tuple[int, ...] = C.RETENTION_WINDOWS) -> DataFrame:
    """Customers with a qualifying order, and how many ordered again
    within 30/60/90 days (strictly after the first order day).

    "Ordered again within N days" holds iff the next distinct order day is at
    most N days after the first, so only the first two order days matter.
    Orders without a customer count as one customer who never comes back.
    """
    t = first_two_order_days(orders, status)
    gap = F.when(F.col("customer_key").isNotNull(), F.datediff(F.col("d2"), F.col("d1")))
    g = t.agg(
        F.count(F.lit(1)).alias("total_customers"),
        *[F.count_if(gap <= w).alias(f"retained_{w}d") for w in windows],
    )
    cols = ["total_customers"] + [f"retained_{w}d" for w in windows]
    cols += [pct(F.col(f"retained_{w}d"), F.col("total_customers"), 1).alias(f"d{w}_pct")
             for w in windows]
    return g.select(*cols)
