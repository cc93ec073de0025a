"""Revenue KPIs: A1 monthly revenue + MoM, A2 category margin, A3 top products,
A5 new vs returning revenue, C7 category margin share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight import constants as C
from tillsight.functions import calendar as cal
from tillsight.functions.money import amount, avg_money, pct
from tillsight.operators.common import COMPLETED, dated, with_status
from tillsight.sources.model import sum_by_product


def _period(orders: DataFrame, grain: str, dates: DataFrame | None = None) -> DataFrame:
    """Period key + label.  ``month`` (the reference's grouping) merges the same
    month of different years; ``year_month`` keeps years apart.

    With ``dates`` (a dim_date frame) the month and its name come from the
    calendar through an inner join on date_key, as in the reference's star
    join (orders on dates missing from the calendar drop out; Spark broadcasts
    the calendar if it is small).  Without it they are derived from
    ``order_date`` by the rules that build dim_date, for orders with a date.
    """
    if dates is not None:
        cal_cols = dates.select("date_key", F.col("year").alias("_y"), F.col("month").alias("_m"),
                                F.col("month_name").alias("_mn"))
        orders = orders.join(cal_cols, "date_key")
        year, month, name = F.col("_y"), F.col("_m"), F.col("_mn")
    else:
        orders, d = dated(orders), F.col("order_date")
        year, month, name = F.year(d), F.month(d), cal.month_name(d)
    if grain == "month":
        return orders.withColumn("_period", month).withColumn("month_name", name)
    if grain == "year_month":
        label = F.format_string("%04d-%02d", year, month)
        return orders.withColumn("_period", year * 12 + month).withColumn("month_name", label)
    raise ValueError(f"unknown grain {grain!r}")


def distinct_count(rows: DataFrame, group: list[str], column: str, name: str) -> DataFrame:
    """Distinct non-null values of a column per group, from narrow distinct rows."""
    return rows.select(*group, column).distinct().groupBy(*group).agg(F.count(column).alias(name))


def monthly_revenue_mom(orders: DataFrame, status: str = COMPLETED,
                        grain: str = "month", dates: DataFrame | None = None) -> DataFrame:
    """A1: orders, customers, revenue and AOV per month, previous month's
    revenue and month-over-month growth % (NULL when the previous is 0)."""
    done = _period(with_status(orders, status), grain, dates)
    period = ["_period", "month_name"]
    # Distinct counts over narrow pairs, sums apart: one aggregate with both would
    # copy every order once for each distinct count.
    monthly = done.groupBy(*period).agg(F.sum("net_revenue").alias("_rev"), F.count("net_revenue").alias("_n"))
    for column, name in (("order_id", "total_orders"), ("customer_key", "unique_customers")):
        monthly = monthly.join(distinct_count(done, period, column, name), period)
    # One row per period (at most 12, or one per calendar month): a single
    # ordered window partition is bounded by the calendar, not the data.
    w = Window.orderBy("_period")
    prev = F.lag("_rev").over(w)
    return monthly.select(
        "_period", "month_name", "total_orders", "unique_customers",
        amount("_rev").alias("net_revenue"),
        avg_money(F.col("_rev"), F.col("_n")).alias("avg_order_value"),
        amount(prev).alias("prev_month_revenue"),
        pct(F.col("_rev") - prev, prev, 1).alias("mom_growth_pct"),
    ).orderBy("_period").drop("_period")


def _category_lookup(products: DataFrame) -> DataFrame:
    return products.select("product_key", "category")


def _distinct_orders(items: DataFrame, products: DataFrame, with_total: bool = False) -> DataFrame:
    """Distinct orders per category from (order_id, product_key) alone.

    Kept apart from the money sums on purpose: Spark plans a distinct count
    next to other aggregates by first grouping on (category, order_id) and
    carrying every partial sum through that line-grained shuffle.  Here that
    shuffle holds two narrow columns, and the sums collapse map-side to one
    row per category in their own aggregation.  ``with_total`` adds the
    grand total row (ROLLUP, ``_gid`` = 1).
    """
    pairs = items.select("order_id", "product_key").join(_category_lookup(products),
                                                         "product_key")
    if not with_total:
        return pairs.groupBy("category").agg(F.count_distinct("order_id").alias("orders"))
    return pairs.rollup("category").agg(F.grouping_id().alias("_gid"),
                                        F.count_distinct("order_id").alias("orders"))


def category_margin(items: DataFrame, products: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """A2: per category distinct orders, units, revenue, cost, margin, margin %.
    All order statuses count (the reference has no status filter).

    ``totals`` has the sums per product (see ``product_totals``); the category
    is joined to those, so no product's lines meet in one task.
    """
    totals = sum_by_product(items) if totals is None else totals
    sums = totals.join(_category_lookup(products), "product_key").groupBy("category").agg(
        F.sum("units").cast("long").alias("units_sold"),
        F.sum("revenue").alias("_rev"),
        F.sum("cost").alias("_cost"),
        F.sum("margin").alias("_margin"),
    )
    # both sides hold one row per category
    return sums.join(_distinct_orders(items, products), "category").select(
        "category", "orders", "units_sold",
        amount("_rev").alias("revenue"), amount("_cost").alias("cost"),
        amount("_margin").alias("gross_margin"),
        pct(F.col("_margin"), F.col("_rev"), 1).alias("margin_pct"),
    ).orderBy(F.col("revenue").desc())


def top_products(items: DataFrame, products: DataFrame, k: int = C.TOP_PRODUCTS,
                 totals: DataFrame | None = None) -> DataFrame:
    """A3: the k products with most revenue, RANK with gaps on ties.

    Lines are summed per product first (``totals``, see ``product_totals``);
    costs and attributes are joined to the per-product sums.  Top-k runs as
    TakeOrderedAndProject, and RANK over those k rows equals the global rank
    (every row ranked above a top-k row is itself in the top k).  Ties at the
    cut are broken by product_key.
    """
    totals = sum_by_product(items) if totals is None else totals
    top = (totals.join(products.select("product_key", "product_name", "category", "brand"), "product_key")
           .orderBy(F.col("revenue").desc(), F.col("product_key").asc())
           .limit(k))
    w = Window.orderBy(F.col("revenue").desc())
    return top.select(
        F.rank().over(w).cast("long").alias("revenue_rank"),
        "product_name", "category", "brand", F.col("units").cast("long").alias("units_sold"),
        amount("revenue").alias("revenue"), amount("margin").alias("gross_margin"),
        avg_money(F.col("discount"), F.col("discounts"), 1).alias("avg_discount_pct"),
        "product_key",
    ).orderBy(F.col("revenue_rank"), F.col("product_key")).drop("product_key")


def new_vs_returning(orders: DataFrame, status: str = COMPLETED,
                     grain: str = "month", dates: DataFrame | None = None) -> DataFrame:
    """A5: revenue from first orders vs other orders per month, returning %."""
    first = F.col("is_first_order")
    rev = F.col("net_revenue")
    g = _period(with_status(orders, status), grain, dates).groupBy("_period", "month_name").agg(
        F.sum(F.when(first, rev).otherwise(F.lit(0))).alias("_new"),
        F.sum(F.when(~first, rev).otherwise(F.lit(0))).alias("_ret"),
        F.sum(rev).alias("_tot"),
    )
    return g.select(
        "_period", "month_name",
        amount("_new").alias("new_customer_rev"),
        amount("_ret").alias("returning_rev"),
        amount("_tot").alias("total_revenue"),
        pct(F.col("_ret"), F.col("_tot"), 1).alias("returning_pct"),
    ).orderBy("_period").drop("_period")


def category_margin_share(items: DataFrame, products: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Each category's share of total gross margin and of distinct orders.

    Margins are summed per product (``totals``), then per category; distinct
    orders per category and in total come from one ROLLUP over the narrow
    (category, order_id) pairs (the total is not the sum of the per-category
    counts).  Totals spread with windows over the category-sized results.
    """
    everything = Window.partitionBy()  # category-sized inputs only
    totals = sum_by_product(items) if totals is None else totals
    margins = totals.join(_category_lookup(products), "product_key").groupBy("category").agg(
        F.sum("margin").alias("_margin"))
    margins = margins.withColumn("_tot_margin", F.sum("_margin").over(everything))
    counts = _distinct_orders(items, products, with_total=True)
    counts = counts.withColumn(
        "_tot_orders", F.max(F.when(F.col("_gid") == 1, F.col("orders"))).over(everything)
    ).filter(F.col("_gid") == 0)
    return margins.join(counts, "category").select(
        "category",
        amount("_margin").alias("gross_margin"),
        pct(F.col("_margin"), F.col("_tot_margin"), 1).alias("margin_share_pct"),
        "orders",
        pct(F.col("orders"), F.col("_tot_orders"), 1).alias("order_share_pct"),
    ).orderBy(F.col("gross_margin").desc())
