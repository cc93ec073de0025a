"""Golden values computed by hand from the reference's sample rows (FIXTURES.md §2)."""

import datetime as dt
from collections import Counter

from tillsight.operators import customers, dashboard, retention, revenue, rolling, segments

AS_OF = dt.date(2024, 6, 30)


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_monthly_revenue_mom(sample):
    r = rows(revenue.monthly_revenue_mom(sample.orders))
    assert [x["month_name"] for x in r] == ["January", "February", "March", "April", "May", "June"]
    assert [x["total_orders"] for x in r] == [6, 9, 13, 12, 16, 12]
    assert [x["unique_customers"] for x in r] == [6, 9, 13, 12, 16, 12]
    assert [x["net_revenue"] for x in r] == [2765.60, 2717.80, 5540.70, 5857.80, 4057.40, 4286.20]
    assert [x["avg_order_value"] for x in r] == [460.93, 301.98, 426.21, 488.15, 253.59, 357.18]
    assert [x["mom_growth_pct"] for x in r] == [None, -1.7, 103.9, 5.7, -30.7, 5.6]
    assert r[0]["prev_month_revenue"] is None and r[1]["prev_month_revenue"] == 2765.60


def test_new_vs_returning(sample):
    r = rows(revenue.new_vs_returning(sample.orders))
    assert [x["returning_rev"] for x in r] == [0.0, 668.20, 3222.00, 2725.30, 3146.40, 2326.50]
    assert [x["returning_pct"] for x in r] == [0.0, 24.6, 58.2, 46.5, 77.5, 54.3]
    for x in r:
        assert round(x["new_customer_rev"] + x["returning_rev"], 2) == x["total_revenue"]


def test_customer_ltv(sample):
    r = rows(customers.customer_ltv(sample.customers, sample.orders))
    assert len(r) == 35
    assert "C030" not in {x["customer_id"] for x in r}  # only a refunded order
    assert Counter(x["ltv_segment"] for x in r) == {"high_value": 4, "mid_value": 13,
                                                     "low_value": 18}
    top = [(x["customer_id"], x["lifetime_value"]) for x in r[:5]]
    assert top == [("C002", 2732.30), ("C007", 2632.30), ("C019", 2283.30),
                   ("C008", 1798.10), ("C001", 1456.60)]
    alice = next(x for x in r if x["customer_id"] == "C001")
    assert alice["customer_name"] == "Alice Morgan" and alice["total_orders"] == 5


def test_customer_ltv_no_purchase(spark, sample):
    from pyspark.sql import functions as F
    extra = sample.customers.filter(F.col("customer_key") == 36).withColumn(
        "customer_key", F.lit(99).cast("long")).withColumn("customer_id", F.lit("C099"))
    r = rows(customers.customer_ltv(sample.customers.unionByName(extra), sample.orders))
    x = next(x for x in r if x["customer_id"] == "C099")
    assert x["ltv_segment"] == "no_purchase" and x["total_orders"] == 0
    assert x["lifetime_value"] is None and x["avg_order_value"] is None
    assert r[0]["customer_id"] == "C099"  # NULL sorts first in DESC, as in PostgreSQL


def test_days_to_second_order(sample):
    r = rows(customers.days_to_second_order(sample.orders))
    assert len(r) == 18
    assert Counter(x["repeat_bucket"] for x in r) == {"0-30 days": 5, "31-60 days": 13}


def test_cohorts(sample):
    r = rows(retention.cohort_retention(sample.orders))
    got = {(x["cohort_month"], x["months_since_first"]): x["active_users"] for x in r}
    expect = {"2024-01": [6, 3, 3, 1, 2], "2024-02": [6, 4, 2, 2], "2024-03": [6, 3, 3],
              "2024-04": [6, 4, 2], "2024-05": [5, 4], "2024-06": [6]}
    assert got == {(c, k): v for c, vs in expect.items() for k, v in enumerate(vs)}
    assert {x["cohort_users"] for x in r} == {6}
    jan = [x["retention_pct"] for x in r if x["cohort_month"] == "2024-01"]
    assert jan == [100.0, 50.0, 50.0, 16.7, 33.3]
    may0 = next(x for x in r if x["cohort_month"] == "2024-05" and x["months_since_first"] == 0)
    assert may0["retention_pct"] == 83.3
    m = {x["cohort_month"]: x for x in rows(retention.cohort_matrix(sample.orders))}
    assert [m["2024-01"][k] for k in ("m0", "m1_pct", "m2_pct", "m3_pct", "m4_pct")] == \
        [6, 50.0, 50.0, 17.0, 33.0]
    assert [m["2024-02"][k] for k in ("m1_pct", "m2_pct", "m3_pct", "m4_pct")] == \
        [67.0, 33.0, 33.0, 0.0]
    assert m["2024-05"]["m0"] == 5 and m["2024-06"]["m1_pct"] == 0.0


def test_day_retention(sample):
    (x,) = rows(retention.day_retention(sample.orders))
    assert x == {"total_customers": 35, "retained_30d": 5, "retained_60d": 18,
                 "retained_90d": 18, "d30_pct": 14.3, "d60_pct": 51.4, "d90_pct": 51.4}


def test_churn(sample):
    r = rows(customers.churn_status(sample.customers, sample.orders, as_of=AS_OF))
    assert Counter(x["churn_status"] for x in r) == {"active": 12, "cooling": 10,
                                                      "at_risk": 2, "churned": 11}


def test_rolling(sample):
    r = rows(rolling.rolling_revenue(sample.orders))
    assert len(r) == 35
    assert r[0]["full_date"] == dt.date(2024, 1, 5) and r[0]["rolling_7d_avg"] == 314.10
    assert r[6]["full_date"] == dt.date(2024, 2, 1) and r[6]["rolling_7d_avg"] == 464.80
    assert r[-1]["rolling_7d_avg"] == 658.60 and r[-1]["cumulative_revenue"] == 25225.50
    assert (r[-1]["full_date"] - r[-7]["full_date"]).days == 36
    total = 0
    for x in r:
        total = round(total + x["daily_revenue"], 2)
        assert x["cumulative_revenue"] == total


def test_pareto(sample):
    r = rows(segments.pareto_quintiles(sample.orders))
    assert [x["customers"] for x in r] == [7] * 5
    assert [x["revenue"] for x in r] == [13366.90, 6354.30, 3286.00, 1657.30, 561.00]
    assert [x["pct_of_revenue"] for x in r] == [53.0, 25.2, 13.0, 6.6, 2.2]


def test_rfm(sample):
    r = rows(segments.rfm_segments(sample.customers, sample.orders, as_of=AS_OF))
    assert len(r) == 35
    for s in ("r_score", "f_score", "m_score"):
        assert Counter(x[s] for x in r) == {1: 7, 2: 7, 3: 7, 4: 7, 5: 7}
    # inverted scores (faithful): the most frequent buyers get f_score 1
    top_f = max(x["frequency"] for x in r)
    assert {x["f_score"] for x in r if x["frequency"] == top_f} == {1}
    for x in r:
        exp = (x["r_score"] + x["f_score"] + x["m_score"]) / 3
        assert abs(x["rfm_score"] - exp) <= 0.05 + 1e-9


def test_rfm_high_is_good(sample):
    r = rows(segments.rfm_segments(sample.customers, sample.orders, as_of=AS_OF,
                                   high_is_good=True))
    top_f = max(x["frequency"] for x in r)
    assert {x["f_score"] for x in r if x["frequency"] == top_f} == {5}


def test_dashboard(sample):
    assert dashboard.executive_dashboard(sample.orders, sample.no_items,
                                         sample.products).count() == 0
    (x,) = rows(dashboard.executive_dashboard(sample.orders, sample.items, sample.products))
    assert x == {"total_net_revenue": 25225.50, "total_orders": 68, "total_customers": 36,
                 "new_customers": 36, "returning_customers": 0, "avg_order_value": 370.96,
                 "top_category": "Electronics", "refund_rate_pct": 4.1, "cancel_rate_pct": 2.7}


def test_item_queries_empty_as_shipped(sample):
    assert revenue.category_margin(sample.no_items, sample.products).count() == 0
    assert revenue.top_products(sample.no_items, sample.products).count() == 0


def test_month_from_calendar_dimension(spark, sample):
    from pyspark.sql import functions as F
    derived = rows(revenue.monthly_revenue_mom(sample.orders))
    via_dim = rows(revenue.monthly_revenue_mom(sample.orders, dates=sample.dates))
    assert via_dim == derived
    # a calendar with its own month names is honoured; missing dates drop out
    renamed = sample.dates.withColumn("month_name", F.upper("month_name")).filter(
        F.col("month") != 6)
    r = rows(revenue.new_vs_returning(sample.orders, dates=renamed))
    assert [x["month_name"] for x in r] == ["JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY"]


def test_rolling_with_calendar_dimension(sample):
    assert rows(rolling.rolling_revenue(sample.orders, dates=sample.dates)) == \
        rows(rolling.rolling_revenue(sample.orders))
