"""One-row executive dashboard."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight import constants as C
from tillsight.functions.money import amount, avg_money, pct
from tillsight.operators.common import COMPLETED
from tillsight.sources.model import sum_by_product


def top_category(totals: DataFrame, products: DataFrame) -> DataFrame:
    """Category with the most line revenue (ties: first by name); <= 1 row.

    ``totals`` has the revenue per product, so the join is at product grain.
    """
    j = totals.select("product_key", "revenue").join(products.select("product_key", "category"), "product_key")
    return (j.groupBy("category").agg(F.sum("revenue").alias("_rev"))
            .orderBy(F.col("_rev").desc(), F.col("category")).limit(1)
            .select(F.col("category").alias("top_category")))


def executive_dashboard(orders: DataFrame, items: DataFrame, products: DataFrame,
                        status: str = COMPLETED, totals: DataFrame | None = None) -> DataFrame:
    """Revenue, orders, customers (any status), new and 'returning'
    customers (customers without a first-order flag), AOV, top category,
    refund and cancel rates.

    Sums and rates are one conditional aggregation over orders; customers are
    counted from a customer-grain partial aggregate and orders from distinct
    ids, so no order is copied for a distinct count.  The one-row results are
    combined by a union and a global aggregate instead of cross joins; like the
    reference's comma join, the result is empty when there is no top category.
    """
    done = F.col("order_status") == status
    rev = F.col("net_revenue")
    sums = orders.agg(
        F.sum(F.when(done, rev)).alias("_rev"),
        F.count(F.when(done, rev)).alias("_rev_n"),
        F.count_if(F.col("order_status") == C.STATUS_REFUNDED).alias("_refunded"),
        F.count_if(F.col("order_status") == C.STATUS_CANCELLED).alias("_cancelled"),
        F.count(F.lit(1)).alias("_all"),
    ).select(
        amount("_rev").alias("total_net_revenue"),
        avg_money(F.col("_rev"), F.col("_rev_n")).alias("avg_order_value"),
        pct(F.col("_refunded"), F.col("_all"), 1).alias("refund_rate_pct"),
        pct(F.col("_cancelled"), F.col("_all"), 1).alias("cancel_rate_pct"),
    )
    new = F.col("_new")
    people = (orders.groupBy("customer_key").agg(F.max("is_first_order").alias("_new"))
              .filter(F.col("customer_key").isNotNull())
              .agg(F.count("customer_key").alias("total_customers"), F.count_if(new).alias("new_customers"))
              .withColumn("returning_customers", F.col("total_customers") - F.col("new_customers")))
    number = orders.filter(done).select("order_id").distinct().agg(F.count("order_id").alias("total_orders"))
    totals = sum_by_product(items) if totals is None else totals
    parts = [sums, people, number, top_category(totals, products).withColumn("_top", F.lit(1))]
    both = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    cols = ["total_net_revenue", "total_orders", "total_customers", "new_customers",
            "returning_customers", "avg_order_value", "top_category",
            "refund_rate_pct", "cancel_rate_pct"]
    # each column is set in one of the one-row parts
    merged = both.agg(*[F.max(c).alias(c) for c in cols], F.max("_top").alias("_has_top"))
    return merged.filter(F.col("_has_top") > 0).select(*cols)
