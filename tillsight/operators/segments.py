"""Customer scoring: A12 revenue quintiles (Pareto), A14 RFM segments."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight import constants as C
from tillsight.functions.money import amount, half_up, pct
from tillsight.functions.ranking import tile_ends, tile_label, with_ntile
from tillsight.operators.common import COMPLETED, customer_name, customer_order_summary, dated, with_status
from tillsight.session import materialize


def pareto_quintiles(orders: DataFrame, status: str = COMPLETED,
                     tiles: int = C.PARETO_TILES) -> DataFrame:
    """Customers by revenue into ``tiles`` NTILE groups (highest first);
    customers, revenue and share of total revenue per group.

    NTILE is computed distributed (range partitioning + checkpointed offsets),
    ties in revenue broken by customer_key.
    """
    per_customer = with_status(orders, status).groupBy("customer_key").agg(
        F.sum("net_revenue").alias("customer_ltv"))
    tiled = with_ntile(per_customer, tiles, [F.col("customer_ltv").desc()],
                       ["customer_key"], out="quintile")
    g = tiled.groupBy("quintile").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("customer_ltv").alias("_rev"))
    total = F.sum("_rev").over(Window.partitionBy())  # over `tiles` rows
    return g.select(
        F.col("quintile").cast("long").alias("quintile"), "customers",
        amount("_rev").alias("revenue"),
        pct(F.col("_rev"), total, 1).alias("pct_of_revenue"),
    ).orderBy("quintile")


def rfm_segments(customers: DataFrame, orders: DataFrame, as_of: _dt.date,
                 status: str = COMPLETED, tiles: int = C.RFM_TILES,
                 high_is_good: bool = False) -> DataFrame:
    """recency/frequency/monetary per current customer, three NTILE(5)
    scores, their mean, and a segment label (first matching rule wins).

    ``high_is_good=False`` keeps the reference's ordering, in which the best
    customers get score 1; ``True`` reverses it so the best get 5.
    Ties are broken by customer_id.  The customers' figures are staged once; each
    score stages only its value and the id, finds the tiles' last rows, and all
    three scores are labelled by comparison with those.
    """
    summary = customer_order_summary(dated(orders), status).filter(F.col("revenue_n") > 0)
    cur = customer_name(customers.filter(F.col("is_current")))
    g = cur.join(summary, "customer_key").groupBy("customer_id", "customer_name").agg(
        F.max("last_order_date").alias("last_order_date"),
        F.sum("total_orders").cast("long").alias("frequency"),
        F.sum("revenue_sum").alias("_monetary"),
    ).withColumn("recency_days",
                 F.datediff(F.lit(as_of), F.col("last_order_date")).cast("long"))
    g = materialize(g)
    scored = g
    for score, value, descending in (("r_score", "recency_days", high_is_good), ("f_score", "frequency", not high_is_good),
                                     ("m_score", "_monetary", not high_is_good)):
        ends = tile_ends(g, tiles, value, "customer_id", descending)
        scored = scored.withColumn(score, tile_label(ends, value, "customer_id", descending))
    r, f = F.col("r_score"), F.col("f_score")
    label = (F.when((r >= 4) & (f >= 4), "Champions").when((r >= 3) & (f >= 3), "Loyal")
             .when((r >= 4) & (f <= 2), "Recent").when((r <= 2) & (f >= 3), "At Risk")
             .when((r <= 2) & (f <= 2), "Lost").otherwise("Potential"))
    return scored.select(
        "customer_id", "customer_name", "last_order_date", "recency_days", "frequency",
        amount("_monetary").alias("monetary"), "r_score", "f_score", "m_score",
        half_up(F.col("r_score") + F.col("f_score") + F.col("m_score"), F.lit(3), 1)
        .alias("rfm_score"),
        label.alias("rfm_segment"),
    ).orderBy(F.col("rfm_score").desc(), F.col("customer_id"))
