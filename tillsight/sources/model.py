"""Canonical star schema built from the generated TPC-H-like tables.

Each function returns a lazily planned view with the reference's column
names and types (money ``decimal(18,2)``, dates ``date``).  Only columns a
query selects are read: the views are projections, and their only joins are
key lookups in a dimension (nation for customers, part for item costs); the
item cost lookup disappears from plans that read no cost column.

Mapping (fixed values, must match the oracle SQL):
  orders.o_orderstatus  F -> completed, P -> cancelled, O -> refunded
  order channel_key     first digit of o_orderpriority (1..5)
  customer age_band     c_acctbal < 0 '18-24', < 2500 '25-34', < 5000 '35-44',
                        < 7500 '45-54', else '55+'
  events event_type     view -> pageview, click -> add_to_cart,
                        signup -> checkout, purchase -> purchase, error -> error
  item unit_price       extendedprice / quantity; item_count = lines of the order
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight import constants as C
from tillsight.functions import calendar as cal
from tillsight.functions.money import MONEY, to_money
from tillsight.sources.testdata import read_table

# Our mapping of the generated tables' codes onto the model's values.
STATUS_MAP = {"F": C.STATUS_COMPLETED, "P": C.STATUS_CANCELLED, "O": C.STATUS_REFUNDED}
EVENT_MAP = {**dict(zip(("view", "click", "signup", "purchase"), C.FUNNEL_STEPS)), "error": "error"}
# As-of date for recency/churn on the generated data: end of its last month.
TESTDATA_AS_OF = _dt.date(2001, 8, 31)
CUSTOMER_EFFECTIVE = _dt.date(1992, 1, 1)


def _map_values(col: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, v) if expr is None else expr.when(col == k, v))
    return expr


def padded_id(prefix: str, key: Column, width: int = 6) -> Column:
    """Prefix and key, zero-padded to ``width`` digits; longer keys stay whole."""
    digits = key.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")))


def _earliest(*columns: str) -> Column:
    """Struct that sorts by order date (none last), then order key."""
    return F.struct(F.col("order_date").isNull().alias("_undated"), F.col("order_date"), F.col("order_key"), *columns)


def first_order_keys(orders: DataFrame) -> DataFrame:
    """C2 core: customer_key and the order key of their earliest order (any status).

    Earliest = smallest (order date, order key), orders without a date last.
    A grouped min with map-side partial aggregation, so a customer with
    millions of orders costs one row per map task, never one task holding all
    of them.  Orders without a customer have no first order.
    """
    return (orders.filter(F.col("customer_key").isNotNull()).groupBy("customer_key")
            .agg(F.min(_earliest()).alias("_first"))
            .select("customer_key", F.col("_first.order_key").alias("_first_order_key")))


def with_first_order_flag(orders: DataFrame) -> DataFrame:
    """Add ``is_first_order`` (C2).  Joins back on the primary key order_key, so the
    join has no hot key even when one customer owns a third of all orders."""
    firsts = first_order_keys(orders).select("_first_order_key")
    return (orders.join(firsts, orders.order_key == firsts._first_order_key, "left")
            .withColumn("is_first_order", F.col("_first_order_key").isNotNull())
            .drop("_first_order_key"))


def orders_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_orders without the first-order flag (no shuffle at all)."""
    return orders_from_raw(read_table(spark, sf_dir, "orders"))


def orders_from_raw(o: DataFrame) -> DataFrame:
    """Row-wise mapping of raw orders to fact_orders columns."""
    d = F.to_date(F.col("o_orderdate"))
    gross = to_money(F.col("o_totalprice"))
    return o.select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderkey").alias("order_id"),
        cal.date_key(d).alias("date_key"),
        d.alias("order_date"),
        F.col("o_custkey").alias("customer_key"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("channel_key"),
        _map_values(F.col("o_orderstatus"), STATUS_MAP).alias("order_status"),
        gross.alias("gross_revenue"),
        F.lit(0).cast(MONEY).alias("discount_amount"),
        gross.alias("net_revenue"),
        F.lit(0).cast(MONEY).alias("shipping_cost"),
    )


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_orders with ``is_first_order`` (C2) and ``item_count``; what a query
    does not read of them is not computed."""
    lines = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"))
    return with_item_count(with_first_order_flag(orders_base(spark, sf_dir)), lines)


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    price = to_money(F.col("p_retailprice"))
    return p.select(
        F.col("p_partkey").alias("product_key"),
        padded_id("P", F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.concat(F.col("p_type"), F.lit(" "), F.col("p_size").cast("string")).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        price.alias("cost_price"),
        price.alias("list_price"),
        F.lit(True).alias("is_active"),
    )


def with_item_count(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Add ``item_count``: lines with the order's order_id (0 without any)."""
    counts = items.groupBy("order_id").agg(F.count(F.lit(1)).cast("int").alias("item_count"))
    return orders.join(counts, "order_id", "left").withColumn("item_count", F.coalesce("item_count", F.lit(0)))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of fact_order_items that need no product."""
    disc = F.col("l_discount").cast("decimal(4,2)")
    price, qty = to_money(F.col("l_extendedprice")), F.col("l_quantity").cast("int")
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_key"),
        qty.alias("quantity"),
        F.when(qty != 0, price / qty).cast(MONEY).alias("unit_price"),
        (disc * 100).cast("decimal(5,2)").alias("discount_pct"),
        F.round(price * (F.lit(1) - disc), 2).cast(MONEY).alias("line_revenue"),
    )


def _product_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_product(spark, sf_dir).groupBy("product_key").agg(F.max("cost_price").alias("cost_price"))


def fact_order_items(spark: SparkSession, sf_dir: str,
                     with_order_context: bool = False) -> DataFrame:
    """fact_order_items: one row per lineitem.

    line_revenue = round(extendedprice * (1 - discount), 2) in decimals;
    line_cost = quantity * product cost_price (lookup in dim_product; NULL
    when the product is unknown, the line itself is kept);
    line_margin = revenue - cost.  ``with_order_context`` adds the order's
    date_key/customer_key (a join with orders no analytic query needs).

    The lookup has provably one row per product, so when a query reads no
    cost column Catalyst removes the left join entirely.
    """
    items = _lines(spark, sf_dir).join(_product_costs(spark, sf_dir), "product_key", "left")
    line_cost = (F.col("quantity") * F.col("cost_price")).cast(MONEY)
    items = items.withColumn("line_cost", line_cost) \
                 .withColumn("line_margin", (F.col("line_revenue") - F.col("line_cost")).cast(MONEY)) \
                 .drop("cost_price")
    if with_order_context:
        ctx = orders_base(spark, sf_dir).groupBy("order_id").agg(
            F.min(F.struct("order_key", "date_key", "customer_key")).alias("_o"))
        items = items.join(ctx, "order_id", "left").select(items["*"], "_o.date_key", "_o.customer_key")
    return items


def product_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of fact_order_items per product: lines are summed before the cost
    lookup, so a product with most of the lines costs one row per map task.
    line_cost is quantity * cost, hence the sum of quantities * cost, exactly."""
    sums = sum_by_product(_lines(spark, sf_dir), with_cost=False)
    costed = sums.join(_product_costs(spark, sf_dir), "product_key", "left")
    cost = F.col("units") * F.col("cost_price")
    return costed.withColumn("cost", cost).withColumn("margin", F.col("revenue") - cost).drop("cost_price")


def sum_by_product(items: DataFrame, with_cost: bool = True) -> DataFrame:
    sums = [F.sum("quantity").cast("decimal(20,0)").alias("units"), F.sum("line_revenue").alias("revenue"),
            F.sum("discount_pct").alias("discount"), F.count("discount_pct").alias("discounts")]
    if with_cost:
        sums += [F.sum("line_cost").alias("cost"), F.sum("line_margin").alias("margin")]
    return items.groupBy("product_key").agg(*sums)


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current customer versions (the generated data has one version each)."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    bal = F.col("c_acctbal")
    age_band = (F.when(bal < 0, "18-24").when(bal < 2500, "25-34")
                .when(bal < 5000, "35-44").when(bal < 7500, "45-54").otherwise("55+"))
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_key"),
        padded_id("C", F.col("c_custkey")).alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("n_name").alias("last_name"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country"),
        F.col("n_name").alias("city"),
        age_band.alias("age_band"),
        F.lower(F.col("c_mktsegment")).alias("acquisition_channel"),
        F.lit(CUSTOMER_EFFECTIVE).alias("effective_date"),
        F.lit(None).cast("date").alias("expiry_date"),
        F.lit(True).alias("is_current"),
    )


def dim_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderpriority").distinct().select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("channel_key"),
        F.col("o_orderpriority").alias("channel_name"),
        F.lit("priority").alias("channel_type"),
    )


def fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_from_raw(read_table(spark, sf_dir, "events"))


def events_from_raw(e: DataFrame) -> DataFrame:
    """Row-wise mapping of raw events to fact_events columns; every event is kept."""
    d = F.to_date(F.col("ts"))
    return e.select(
        F.col("event_id").alias("event_key"),
        cal.date_key(d).alias("date_key"),
        F.col("user_id").alias("customer_key"),
        # an event without user or time has no session (NULL), whatever reads it
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format(d, "yyyyMMdd")).alias("session_id"),
        F.coalesce(_map_values(F.col("event_type"), EVENT_MAP), F.col("event_type")).alias("event_type"),
        d.alias("event_date"),
        F.col("ts").alias("event_ts"),
        F.lit(None).cast("int").alias("channel_key"),
    )


@dataclass
class Star:
    """The canonical star schema of one data folder, planned lazily."""
    spark: SparkSession
    sf_dir: str

    @property
    def orders(self) -> DataFrame:
        return fact_orders(self.spark, self.sf_dir)

    @property
    def orders_base(self) -> DataFrame:
        return orders_base(self.spark, self.sf_dir)

    @property
    def items(self) -> DataFrame:
        return fact_order_items(self.spark, self.sf_dir)

    @property
    def product_totals(self) -> DataFrame:
        return product_totals(self.spark, self.sf_dir)

    @property
    def products(self) -> DataFrame:
        return dim_product(self.spark, self.sf_dir)

    @property
    def customers(self) -> DataFrame:
        return dim_customer(self.spark, self.sf_dir)

    @property
    def channels(self) -> DataFrame:
        return dim_channel(self.spark, self.sf_dir)

    @property
    def events(self) -> DataFrame:
        return fact_events(self.spark, self.sf_dir)

    def tables(self) -> dict[str, DataFrame]:
        """All seven tables as they are loaded."""
        items = fact_order_items(self.spark, self.sf_dir, with_order_context=True)
        return {"dim_date": self.dates, "dim_customer": self.customers, "dim_product": self.products,
                "dim_channel": self.channels, "fact_orders": self.orders,
                "fact_order_items": items.withColumn("item_key", F.monotonically_increasing_id() + 1),
                "fact_events": self.events}

    @property
    def dates(self) -> DataFrame:
        from tillsight.operators.prep import dim_date_build
        return dim_date_build(self.orders_base)


# Effective date of the re-attribution snapshot applied by the SCD2 query.
TESTDATA_SCD_EFFECTIVE = _dt.date(2001, 9, 1)


def first_order_channel_snapshot(orders: DataFrame) -> DataFrame:
    """Snapshot for SCD2: each ordering customer's acquisition channel
    re-attributed to the channel of their first order (grouped min over
    (date, order id), no per-customer sort)."""
    first = orders.filter(F.col("customer_key").isNotNull()).groupBy("customer_key").agg(
        F.min(_earliest("channel_key")).alias("_f"))
    return first.select(padded_id("C", F.col("customer_key")).alias("customer_id"),
                        F.concat(F.lit("channel-"), F.col("_f.channel_key").cast("string"))
                        .alias("acquisition_channel"))


def attach_order_date(orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Star join of stored orders with the date dimension (inner, as the
    reference joins): adds ``order_date``.  Spark broadcasts the calendar if it is small."""
    return orders.join(dim_date.select("date_key", F.col("full_date").alias("order_date")), "date_key")


def channel_changes(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """A change feed for histories: each customer's channel when they became one, and for every
    refunded order the order's channel from its date (the order key is the order of arrival)."""
    first = customers.select("customer_key", "acquisition_channel", F.col("effective_date").alias("changed_on"),
                             F.lit(-1).cast("long").alias("sequence"))
    moved = orders.filter(F.col("order_status") == C.STATUS_REFUNDED).select(
        "customer_key", F.concat(F.lit("channel-"), F.col("channel_key").cast("string")).alias("acquisition_channel"),
        F.col("order_date").alias("changed_on"), F.col("order_key").alias("sequence"))
    return first.unionByName(moved)
