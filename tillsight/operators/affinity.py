"""Product pairs bought in the same order (cross-sell)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight import constants as C
from tillsight.functions import pairs


def product_affinity(items: DataFrame, products: DataFrame,
                     k: int = C.TOP_PAIRS) -> DataFrame:
    """Pairs of different products (key a < key b) in one order, counted
    as line pairs and grouped by product *names* (same-named products merge,
    as in the reference); the k most frequent pairs.

    Lines collapse to (order, product, lines) first, from two narrow columns, so
    a product repeated on several lines of an order is paired once and weighted
    ``n_a * n_b``.  Names are joined to these rows, which are fewer than the pairs
    (AQE splits a product in most orders), so that pairs are counted by name at
    once.  Pairs are listed and counted in as many tasks as their number asks for
    (``pairs.Deal``, which also deals a large order to several), so a task's memory
    does not follow the input.  Work is the number of co-occurring product
    pairs, which is the size of the relation being counted: quadratic in the
    distinct products of an order.
    """
    basket = items.groupBy("order_id", "product_key").agg(F.count(F.lit(1)).alias("n"))
    deal = pairs.Deal(basket, "order_id", "product_key")
    named = basket.filter("order_id IS NOT NULL").join(products.select("product_key", F.col("product_name").alias("product")), "product_key")
    g = pairs.counted_pairs(named, deal, "product", "n").withColumnRenamed("n", "times_bought_together")
    return (g.filter(F.col("times_bought_together") >= 1)
            .orderBy(F.col("times_bought_together").desc(), "product_a", "product_b")
            .limit(k))
