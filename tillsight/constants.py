"""Fixed values that results must carry exactly as the reference workload does.

Kept together, in natural order, so the rule tables below are the single
place where labels and thresholds live; operators take them as defaults.
"""

# ---- fixed values -----------------------------------------------------------
# Order statuses.
STATUS_COMPLETED = "completed"
STATUS_REFUNDED = "refunded"
STATUS_CANCELLED = "cancelled"
ORDER_STATUSES = (STATUS_COMPLETED, STATUS_REFUNDED, STATUS_CANCELLED)

# Lifetime value from which a customer is high_value, mid_value (above 0: low_value).
LTV_HIGH, LTV_MID = 1500, 500

# Days from first to second order: upper bounds of the buckets (inclusive).
REPEAT_BUCKET_BOUNDS = (30, 60, 90)   # labels: 0-30, 31-60, 61-90, 90+ days

# Churn: more than N days since the last order, tested from the largest.
CHURN_THRESHOLDS = (30, 60, 90)       # cooling > 30, at_risk > 60, churned > 90

# Retention windows in days after the first order.
RETENTION_WINDOWS = (30, 60, 90)

# RFM: number of tiles.
RFM_TILES = 5

# Cohort matrix: month offsets shown (0 as a count, 1..4 as percents).
COHORT_MONTHS = 4

# Rolling average frame in rows; top-k sizes; revenue quintiles.
ROLLING_ROWS = 7
TOP_PRODUCTS = 10
TOP_PAIRS = 15
PARETO_TILES = 5

# Funnel steps in order.
FUNNEL_STEPS = ("pageview", "add_to_cart", "checkout", "purchase")

# Column defaults of the star schema (applied when an insert omits the column).
COLUMN_DEFAULTS = {
    "dim_date": {"is_weekend": False, "is_holiday": False},
    "dim_customer": {"is_current": True},
    "dim_product": {"is_active": True},
    "fact_orders": {"discount_amount": 0, "shipping_cost": 0, "is_first_order": False},
    "fact_order_items": {"discount_pct": 0},
}

# As-of date of the reference sample data.
SAMPLE_AS_OF = "2024-06-30"
# ---- end of fixed values ----------------------------------------------------
