"""Distinct counts by day, month and in all from kept sets; quartiles of order values; best pairs by bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions import distinct, pairs
from tillsight.functions.money import pct
from tillsight.functions.quantiles import BUCKETS, quantiles
from tillsight.operators.common import COMPLETED, dated, with_status
from tillsight.session import materialize

IDS = ("orders", "customers")


def distinct_by_day(orders: DataFrame, items: DataFrame, products: DataFrame, status: str | None = COMPLETED) -> DataFrame:
    """Sets of order keys and customer keys for each day and category: the state to keep and merge."""
    category = products.select("product_key", "category")
    lines = items.select("order_id", "product_key").join(category, "product_key").select("order_id", "category")
    sold = dated(with_status(orders, status)).select("order_id", "order_date", F.col("order_key").alias("orders"),
                                                     F.col("customer_key").alias("customers"))
    return distinct.id_sets(lines.join(sold, "order_id"), ["order_date", "category"], IDS)


def distinct_rollup(days: DataFrame) -> DataFrame:
    """Distinct orders and customers by day and category, month and category, month, and in all.

    ``days`` is ``distinct_by_day``, of any number of loads put together; each level is
    merged from the one below.
    """
    by_day = materialize(distinct.merge_sets(days, period=F.col("order_date"), category=F.col("category")))
    by_category = materialize(distinct.merge_sets(by_day, period=F.trunc("period", "month"), category=F.col("category")))
    by_month = materialize(distinct.merge_sets(by_category, period=F.col("period")))
    in_all = distinct.merge_sets(by_month, period=F.lit(None).cast("date"))
    levels = [("day and category", by_day), ("month and category", by_category),
              ("month", by_month.withColumn("category", F.lit(None).cast("string"))),
              ("all", in_all.withColumn("category", F.lit(None).cast("string")))]
    out = None
    for name, sets in levels:
        level = distinct.set_sizes(sets, ["period", "category"], IDS).select(F.lit(name).alias("level"), "period", "category", *IDS)
        out = level if out is None else out.unionByName(level)
    return out


def top_product_pairs(items: DataFrame, k: int = 20, first: int = 1000) -> DataFrame:
    """The ``k`` pairs of products that most orders hold, with how many; ties by key.

    A pair is in no more orders than its rarer product.  Pairs among the ``first`` products
    with the most orders give k counts; the least of them is a bound that every pair of the
    answer reaches, so only products in that many orders are paired in the second round:
    exact, and pairs of rare products are never listed.  ``first`` changes the time only.
    An order's pairs are quadratic in its products that reach the bound.  Pairs are listed
    and counted in as many tasks as their number asks for (``pairs.Deal``), so a task's
    memory does not follow the input.
    """
    lines = items.filter("order_id IS NOT NULL AND product_key IS NOT NULL").select("order_id", "product_key")
    basket = materialize(lines.distinct())
    held = materialize(basket.groupBy("product_key").agg(F.count(F.lit(1)).alias("n")))
    deal = pairs.Deal(basket, "order_id", "product_key")

    def best(least: int) -> DataFrame:
        some = basket.join(held.filter(F.col("n") >= least).select("product_key"), "product_key", "left_semi")
        counted = pairs.counted_pairs(some, deal, "product_key").toDF("product_a", "product_b", "orders")
        return counted.orderBy(F.col("orders").desc(), "product_a", "product_b").limit(k)

    start = held.orderBy(F.col("n").desc()).limit(first).agg(F.min("n")).first()[0] or 1
    found = materialize(best(start))
    reached = found.agg(F.count(F.lit(1)).alias("pairs"), F.min("orders").alias("orders")).first()
    bound = reached["orders"] if reached["pairs"] == k else 1
    if bound < start:
        found = best(bound)
    for side in "ab":
        found = found.join(held.select(F.col("product_key").alias(f"product_{side}"), F.col("n").alias(f"orders_{side}")), f"product_{side}")
    return found.select("product_a", "product_b", "orders", "orders_a", "orders_b",
                        pct(F.col("orders"), F.least("orders_a", "orders_b")).alias("pct_of_rarer")
                        ).orderBy(F.col("orders").desc(), "product_a", "product_b")


def order_value_quartiles(items: DataFrame, products: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """By category: orders, and exact quartiles of what an order spends in it (all statuses)."""
    spent = (items.select("order_id", "product_key", "line_revenue").join(products.select("product_key", "category"), "product_key")
             .groupBy("order_id", "category").agg((F.sum("line_revenue") * 100).cast("long").alias("cents")))
    found = quantiles(spent, ["category"], "cents", {"quartile_1": (1, 4), "median": (1, 2), "quartile_3": (3, 4), "percentile_99": (99, 100)},
                      100, buckets)
    return found.withColumnRenamed("n", "orders").orderBy("category")
