"""Edge cases listed in FIXTURES.md §3 (our own invented orders)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.operators import customers, retention, revenue
from tillsight.sources import fixtures as fx

D = dt.date


@pytest.fixture(scope="module")
def edge_orders(spark):
    rows = []
    k = 0

    def add(cust, day, status="completed", net="100.00"):
        nonlocal k
        k += 1
        rows.append((k, f"E{k:03d}", int(day.strftime("%Y%m%d")), cust, 1, status, 1,
                     Decimal(net), Decimal("0"), Decimal(net), Decimal("0"), False, day))
    add(1, D(2024, 1, 10)); add(1, D(2024, 1, 10)); add(1, D(2024, 2, 1))   # same-day pair
    for cust, gap in [(2, 30), (3, 31), (4, 60), (5, 61), (6, 90), (7, 91)]:
        add(cust, D(2024, 1, 1)); add(cust, D(2024, 1, 1) + dt.timedelta(days=gap))
    add(8, D(2024, 1, 5))                                                 # single order
    add(9, D(2024, 1, 5), status="refunded")                              # only refunded
    add(10, D(2023, 3, 15))                                               # two years of March
    add(10, D(2024, 3, 15))
    add(11, D(2024, 6, 3), net="0.00")                                    # June revenue 0
    add(11, D(2024, 7, 3))
    schema = T.StructType(fx.FACT_ORDERS_SCHEMA.fields + [T.StructField("order_date", T.DateType())])
    df = spark.createDataFrame(rows, schema)
    from tillsight.operators.prep import first_order_flag
    return first_order_flag(df.drop("is_first_order"))


def test_second_order_gaps_and_buckets(edge_orders):
    r = {x.customer_key: x for x in customers.days_to_second_order(edge_orders).collect()}
    assert set(r) == {1, 2, 3, 4, 5, 6, 7, 10, 11}
    assert r[1].days_between_orders == 0 and r[1].second_order_date == D(2024, 1, 10)
    got = {c: (r[c].days_between_orders, r[c].repeat_bucket) for c in range(2, 8)}
    assert got == {2: (30, "0-30 days"), 3: (31, "31-60 days"), 4: (60, "31-60 days"),
                   5: (61, "61-90 days"), 6: (90, "61-90 days"), 7: (91, "90+ days")}


def test_day_retention_windows(edge_orders):
    (x,) = retention.day_retention(edge_orders).collect()
    # completed customers: 1..8, 10, 11 (9 only refunded)
    assert x.total_customers == 10
    # next distinct day: 1 -> 22 days, 2 -> 30, 3 -> 31, 4 -> 60, 5 -> 61, 6 -> 90, 7 -> 91,
    # 10 -> 366, 11 -> 30 (the zero-revenue order still counts)
    assert (x.retained_30d, x.retained_60d, x.retained_90d) == (3, 5, 7)
    assert x.d30_pct == 30.0


def test_month_grain_and_zero_guard(edge_orders):
    merged = {x.month_name: x for x in revenue.monthly_revenue_mom(edge_orders).collect()}
    # 2023-03 (1 order) and 2024-03 (4: customers 4, 5, 6 and 10) merge, as in the reference
    assert merged["March"].total_orders == 5
    split = {x.month_name: x for x in revenue.monthly_revenue_mom(
        edge_orders, grain="year_month").collect()}
    assert split["2023-03"].total_orders == 1 and split["2024-03"].total_orders == 4
    # June revenue is 0: July's growth is NULL (NULLIF guard), June's is -100 %
    assert merged["June"].net_revenue == 0.0 and merged["June"].mom_growth_pct == -100.0
    assert merged["July"].mom_growth_pct is None


def test_orders_on_expired_key_are_not_counted(spark, sample):
    moved = sample.orders.withColumn(
        "customer_key", F.when(F.col("order_id") == "ORD-001", F.lit(101).cast("long"))
        .otherwise(F.col("customer_key")))
    r = {x.customer_id: x for x in customers.customer_ltv(sample.customers, moved).collect()}
    assert r["C001"].total_orders == 4  # ORD-001 sits on the expired version (key 101)
    assert r["C001"].lifetime_value == 1142.50
