"""Customer metrics: A4 lifetime value, A6 days to second order, A10 churn."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight import constants as C
from tillsight.functions.money import amount, avg_money
from tillsight.operators.common import (COMPLETED, customer_name, customer_order_summary,
                                        dated, first_two_order_days)


def _current(customers: DataFrame) -> DataFrame:
    return customer_name(customers.filter(F.col("is_current")))


def customer_ltv(customers: DataFrame, orders: DataFrame, status: str = COMPLETED) -> DataFrame:
    """A4: lifetime value per current customer with a value segment.

    As in the reference's LEFT JOIN filtered in WHERE: a customer without any
    order is kept ('no_purchase', 0 orders); a customer whose orders all have
    another status is dropped.  Orders are summarised per customer_key first,
    so the join with the dimension is 1:1.
    """
    summary = customer_order_summary(orders, status, include_null_status=True)
    j = _current(customers).join(summary, "customer_key", "left").filter(
        F.col("order_count_any").isNull() | (F.col("revenue_n") > 0)
        | (F.col("total_orders") > 0))
    g = j.groupBy("customer_id", "customer_name", "country", "age_band",
                  "acquisition_channel").agg(
        F.coalesce(F.sum("total_orders"), F.lit(0)).cast("long").alias("total_orders"),
        F.sum("revenue_sum").alias("_ltv"),
        F.sum("revenue_n").alias("_n"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
    )
    ltv = F.col("_ltv")
    segment = (F.when(ltv >= C.LTV_HIGH, "high_value").when(ltv >= C.LTV_MID, "mid_value")
               .when(ltv > 0, "low_value").otherwise("no_purchase"))
    return g.select(
        "customer_id", "customer_name", "country", "age_band", "acquisition_channel",
        "total_orders",
        amount(ltv).alias("lifetime_value"),
        avg_money(ltv, F.col("_n")).alias("avg_order_value"),
        "first_order_date", "last_order_date",
        segment.alias("ltv_segment"),
    ).orderBy(F.col("lifetime_value").desc_nulls_first(), F.col("customer_id"))


def days_to_second_order(orders: DataFrame, status: str = COMPLETED,
                         buckets: tuple[int, int, int] = C.REPEAT_BUCKET_BOUNDS) -> DataFrame:
    """Gap in days between each customer's first and second order.

    Two orders on the first day give a second order on that day (0 days).
    Customers with a single order, and orders without customer or date, are absent.
    """
    t = first_two_order_days(orders.filter(F.col("customer_key").isNotNull()), status)
    second = F.when(F.col("n1") >= 2, F.col("d1")).otherwise(F.col("d2"))
    gap = F.datediff(F.col("second_order_date"), F.col("first_order_date")).cast("long")
    b1, b2, b3 = buckets
    bucket = (F.when(F.col("days_between_orders") <= b1, f"0-{b1} days")
              .when(F.col("days_between_orders") <= b2, f"{b1 + 1}-{b2} days")
              .when(F.col("days_between_orders") <= b3, f"{b2 + 1}-{b3} days")
              .otherwise(f"{b3}+ days"))
    return (t.select("customer_key", F.col("d1").alias("first_order_date"),
                     second.alias("second_order_date"))
            .filter(F.col("second_order_date").isNotNull())
            .withColumn("days_between_orders", gap)
            .withColumn("repeat_bucket", bucket)
            .orderBy("days_between_orders", "customer_key"))


def churn_status(customers: DataFrame, orders: DataFrame, as_of: _dt.date,
                 status: str = COMPLETED,
                 thresholds: tuple[int, int, int] = C.CHURN_THRESHOLDS) -> DataFrame:
    """A10: last order, orders, spend and churn label per current customer
    with at least one qualifying order (inner joins)."""
    summary = customer_order_summary(dated(orders), status).filter(F.col("revenue_n") > 0)
    j = _current(customers).join(summary, "customer_key")
    g = j.groupBy("customer_id", "customer_name", "country").agg(
        F.max("last_order_date").alias("last_order_date"),
        F.sum("total_orders").cast("long").alias("total_orders"),
        F.sum("revenue_sum").alias("_spent"),
    )
    days = F.datediff(F.lit(as_of), F.col("last_order_date")).cast("long")
    cooling, at_risk, churned = thresholds
    idle = F.col("days_since_last_order")
    label = (F.when(idle > churned, "churned").when(idle > at_risk, "at_risk")
             .when(idle > cooling, "cooling").otherwise("active"))
    return (g.select("customer_id", "customer_name", "country", "last_order_date",
                     "total_orders", amount("_spent").alias("total_spent"),
                     days.alias("days_since_last_order"))
            .withColumn("churn_status", label)
            .orderBy(F.col("days_since_last_order").desc(), F.col("customer_id")))
