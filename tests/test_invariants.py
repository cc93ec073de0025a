"""Invariants on the generated data (SURVEY §5 (4))."""

import os
from collections import Counter

import pytest

from __spark_entry__ import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="generated data missing")


def rows(spark, name):
    return [r.asDict() for r in queries()[name](spark, SF_DIR).collect()]


def test_tiles_are_balanced(spark):
    sizes = [r["customers"] for r in rows(spark, "q12_pareto_quintiles")]
    assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)
    rfm = rows(spark, "q14_rfm_segments")
    for score in ("r_score", "f_score", "m_score"):
        counts = Counter(r[score] for r in rfm).values()
        assert max(counts) - min(counts) <= 1


def test_cohorts_bounded_by_size(spark):
    for r in rows(spark, "q07_cohort_retention"):
        assert 0 < r["active_users"] <= r["cohort_users"]
    for r in rows(spark, "q08_cohort_matrix"):
        assert r["m0"] <= r["cohort_users"]
        assert all(0 <= r[f"m{i}_pct"] <= 100 for i in range(1, 5))


def test_running_total_and_split(spark):
    daily = rows(spark, "q11_rolling_revenue")
    assert daily[-1]["cumulative_revenue"] == pytest.approx(sum(r["daily_revenue"] for r in daily))
    for r in rows(spark, "q05_new_vs_returning"):
        assert r["new_customer_rev"] + r["returning_rev"] == pytest.approx(r["total_revenue"])


def test_retention_windows_nest(spark):
    (r,) = rows(spark, "q09_day_retention")
    assert r["retained_30d"] <= r["retained_60d"] <= r["retained_90d"] <= r["total_customers"]


def test_funnel_never_grows(spark):
    reached = [r["sessions_reached"] for r in rows(spark, "c6_funnel_sessions")]
    assert reached == sorted(reached, reverse=True)


def test_dashboard_consistent_with_parts(spark):
    (d,) = rows(spark, "q15_executive_dashboard")
    assert d["new_customers"] + d["returning_customers"] == d["total_customers"]
    total = sum(r["total_revenue"] for r in rows(spark, "q05_new_vs_returning"))
    assert d["total_net_revenue"] == pytest.approx(total)
