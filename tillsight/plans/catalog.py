"""Registered queries.

Each query is written against a star (``Star`` over the generated tables, or
``WarehouseStar`` over a loaded warehouse) and registered as a job
``(spark, data folder) -> DataFrame`` over the generated tables.  Every query
reads whole tables with the operator's default parameters (as-of date = end
of the data's last month).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillsight.operators import (affinity, customers, dashboard, funnel, prep, quality,
                                 retention, revenue, rolling, rollups, segments, timelines)
from tillsight.sources.model import (TESTDATA_AS_OF, TESTDATA_SCD_EFFECTIVE, Star, channel_changes,
                                     first_order_channel_snapshot)

Query = Callable[[SparkSession, str], DataFrame]
StarQuery = Callable[[object], DataFrame]

STAR_QUERIES: dict[str, StarQuery] = {}


def register(fn: StarQuery) -> StarQuery:
    STAR_QUERIES[fn.__name__] = fn
    return fn


def run_on(star, name: str) -> DataFrame:
    """Run a registered query on any star (generated tables or a warehouse)."""
    return STAR_QUERIES[name](star)


@register
def q01_monthly_revenue_mom(s):
    return revenue.monthly_revenue_mom(s.orders_base)


@register
def q02_category_margin(s):
    return revenue.category_margin(s.items, s.products, s.product_totals)


@register
def q03_top_products(s):
    return revenue.top_products(s.items, s.products, totals=s.product_totals)


@register
def q04_customer_ltv(s):
    return customers.customer_ltv(s.customers, s.orders_base)


@register
def q05_new_vs_returning(s):
    return revenue.new_vs_returning(s.orders)


@register
def q06_days_to_second_order(s):
    return customers.days_to_second_order(s.orders_base)


@register
def q07_cohort_retention(s):
    return retention.cohort_retention(s.orders)


@register
def q08_cohort_matrix(s):
    return retention.cohort_matrix(s.orders)


@register
def q09_day_retention(s):
    return retention.day_retention(s.orders_base)


@register
def q10_churn_status(s):
    return customers.churn_status(s.customers, s.orders_base, as_of=TESTDATA_AS_OF)


@register
def q11_rolling_revenue(s):
    return rolling.rolling_revenue(s.orders_base)


@register
def q12_pareto_quintiles(s):
    return segments.pareto_quintiles(s.orders_base)


@register
def q13_product_affinity(s):
    return affinity.product_affinity(s.items, s.products)


@register
def q14_rfm_segments(s):
    return segments.rfm_segments(s.customers, s.orders_base, as_of=TESTDATA_AS_OF)


@register
def q15_executive_dashboard(s):
    return dashboard.executive_dashboard(s.orders, s.items, s.products, totals=s.product_totals)


@register
def c7_category_margin_share(s):
    return revenue.category_margin_share(s.items, s.products, s.product_totals)


@register
def c1_dim_date(s):
    return prep.dim_date_build(s.orders_base)


@register
def c2_first_order_flag(s):
    return prep.first_order_flag(s.orders_base.drop("is_first_order")).select(
        "order_id", "customer_key", "order_date", "is_first_order")


@register
def c3_scd2_apply(s):
    return prep.scd2_apply(s.customers, first_order_channel_snapshot(s.orders_base),
                           natural_key="customer_id", surrogate_key="customer_key",
                           tracked=["acquisition_channel"], effective=TESTDATA_SCD_EFFECTIVE)


@register
def c4_dq_checks(s):
    return quality.dq_checks(quality.star_tables(s))


@register
def c5_surrogate_keys(s):
    return prep.assign_surrogate_keys(s.events, "session_id", "session_key")


@register
def c6_funnel_counts(s):
    return funnel.funnel_counts(s.events)


@register
def c6_funnel_sessions(s):
    return funnel.funnel_sessions(s.events)


@register
def c8_order_arithmetic_check(s):
    return quality.order_arithmetic_check(s.orders, s.items)


def _channel_history(s):
    return timelines.history_from_changes(channel_changes(s.customers, s.orders_base), "customer_key",
                                          ["acquisition_channel"], "changed_on", "sequence")


@register
def t1_channel_at_order_time(s):
    return timelines.revenue_by_value_at_order(s.orders_base, _channel_history(s), "customer_key", "acquisition_channel")


@register
def t2_orders_after_first(s):
    return timelines.orders_after_first(s.orders_base)


@register
def t3_channel_history(s):
    return _channel_history(s)


@register
def t4_running_revenue(s):
    return timelines.running_revenue(s.orders_base)


@register
def t5_revenue_last_days(s):
    return timelines.revenue_last_days(s.orders_base)


@register
def t6_session_funnel(s):
    return timelines.session_funnel(s.events)


@register
def t7_distinct_rollup(s):
    return rollups.distinct_rollup(rollups.distinct_by_day(s.orders_base, s.items, s.products))


@register
def t8_top_product_pairs(s):
    return rollups.top_product_pairs(s.items)


@register
def t9_order_value_quartiles(s):
    return rollups.order_value_quartiles(s.items, s.products)


def _over_generated(name: str) -> Query:
    def job(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_on(Star(spark, sf_dir), name)
    job.__name__ = name
    return job


QUERIES: dict[str, Query] = {name: _over_generated(name) for name in STAR_QUERIES}
