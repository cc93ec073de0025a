"""Daily revenue with a rolling average over the last N order days and a running total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight import constants as C
from tillsight.functions.money import amount, avg_money
from tillsight.operators.common import COMPLETED, dated, with_status


def rolling_revenue(orders: DataFrame, status: str = COMPLETED,
                    rows: int = C.ROLLING_ROWS, dates: DataFrame | None = None) -> DataFrame:
    """A11.  The frame is ``rows`` *rows* (days that have orders), as in the
    reference, not calendar days.  With ``dates`` the day comes from the
    calendar dimension (inner join on date_key, as in the reference).

    The data is aggregated to one row per day first (partial aggregation, any
    scale); the ordered windows then run over that calendar-bounded result,
    where a single window partition is cheap.
    """
    done = with_status(orders, status)
    if dates is None:
        done = dated(done).withColumn("full_date", F.col("order_date"))
    else:
        done = done.join(dates.select("date_key", "full_date"), "date_key")
    daily = done.groupBy("full_date").agg(
        F.sum("net_revenue").alias("_rev"),
        F.count_distinct("order_id").alias("daily_orders"),
    )
    w = Window.orderBy("full_date")
    last_n = w.rowsBetween(-(rows - 1), Window.currentRow)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(
        "full_date",
        amount("_rev").alias("daily_revenue"),
        "daily_orders",
        avg_money(F.sum("_rev").over(last_n), F.count("_rev").over(last_n)).alias("rolling_7d_avg"),
        amount(F.sum("_rev").over(running)).alias("cumulative_revenue"),
    ).orderBy("full_date")
