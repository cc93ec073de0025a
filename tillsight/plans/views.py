"""Expose a star as SQL temp views, so existing SQL runs through ``spark.sql``.

Views: fact_orders, fact_order_items, dim_customer, dim_product, dim_channel,
dim_date (C1 over the orders' date range) and fact_events.  Catalyst plans
SQL over these views exactly like the DataFrame operators.
"""

from __future__ import annotations

from tillsight.operators.prep import dim_date_build

VIEW_NAMES = ("fact_orders", "fact_order_items", "dim_customer", "dim_product",
              "dim_channel", "dim_date", "fact_events")


def register_star_views(star, prefix: str = "") -> list[str]:
    """Create or replace the star's temp views; returns their names."""
    frames = {
        "fact_orders": star.orders,
        "fact_order_items": star.items,
        "dim_customer": star.customers,
        "dim_product": star.products,
        "dim_channel": star.channels,
        "dim_date": dim_date_build(star.orders_base),
        "fact_events": star.events,
    }
    names = []
    for name in VIEW_NAMES:
        frames[name].createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
