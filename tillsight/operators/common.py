"""Small building blocks shared by several operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.constants import STATUS_COMPLETED as COMPLETED


def with_status(orders: DataFrame, status: str | None = COMPLETED) -> DataFrame:
    """Orders of one status (pushed into the scan by Catalyst); None = all."""
    if status is None:
        return orders
    return orders.filter(F.col("order_status") == status)


def dated(orders: DataFrame) -> DataFrame:
    """Orders that the star join to the calendar keeps: those with a date."""
    return orders.filter(F.col("order_date").isNotNull())


def first_two_order_days(orders: DataFrame, status: str | None = COMPLETED) -> DataFrame:
    """Per customer: first order day ``d1``, orders on it ``n1``, next order day ``d2``.

    Orders are first collapsed to (customer, day) with map-side partial
    aggregation, so a customer's group is bounded by the number of calendar
    days, not by its order count.  ``row_number <= 2`` is then planned as a
    WindowGroupLimit, and the final per-customer aggregate reuses the window's
    partitioning (no further shuffle).
    """
    days = dated(with_status(orders, status)).groupBy("customer_key", "order_date").agg(
        F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("customer_key").orderBy("order_date")
    top = days.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= 2)
    return top.groupBy("customer_key").agg(
        F.min(F.when(F.col("rn") == 1, F.col("order_date"))).alias("d1"),
        F.max(F.when(F.col("rn") == 1, F.col("n"))).alias("n1"),
        F.min(F.when(F.col("rn") == 2, F.col("order_date"))).alias("d2"),
    )


def customer_order_summary(orders: DataFrame, status: str | None = COMPLETED,
                           include_null_status: bool = False) -> DataFrame:
    """Per customer_key: distinct orders, revenue sum/count, first/last date.

    Aggregated before any join with the customer dimension, so the join is
    1:1 and a hot customer is collapsed map-side.  ``order_count_any`` counts
    orders of every status (used to tell 'no orders' from 'none qualifying').
    The distinct order count runs on narrow (customer, order) pairs and the
    other figures in a separate map-side-combined aggregation; both results
    are hash-partitioned on customer_key, so joining them needs no shuffle.
    """
    keep = F.col("order_status") == status if status is not None else F.lit(True)
    if include_null_status:
        keep = keep | F.col("order_status").isNull()
    figures = orders.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("order_count_any"),
        F.sum(F.when(keep, F.col("net_revenue"))).alias("revenue_sum"),
        F.count(F.when(keep, F.col("net_revenue"))).alias("revenue_n"),
        F.min(F.when(keep, F.col("order_date"))).alias("first_order_date"),
        F.max(F.when(keep, F.col("order_date"))).alias("last_order_date"),
    )
    distinct = orders.filter(keep).groupBy("customer_key").agg(
        F.count_distinct("order_id").alias("total_orders"))
    return figures.join(distinct, "customer_key", "left").withColumn(
        "total_orders", F.coalesce(F.col("total_orders"), F.lit(0)))


def customer_name(customers: DataFrame) -> DataFrame:
    return customers.withColumn(
        "customer_name", F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")))
