"""Funnel conversion over web events (pageview -> add-to-cart -> checkout -> purchase)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight import constants as C
from tillsight.functions.money import pct
from tillsight.operators.revenue import distinct_count

STEPS = C.FUNNEL_STEPS


def _steps_frame(events: DataFrame, steps: Sequence[str]) -> DataFrame:
    """The step list as a tiny frame (step_order, event_type)."""
    arr = F.array(*[F.lit(s) for s in steps])
    return events.sparkSession.range(1, len(steps) + 1).select(
        F.col("id").alias("step_order"),
        F.element_at(arr, F.col("id").cast("int")).alias("event_type"))


def funnel_counts(events: DataFrame, steps: Sequence[str] = STEPS) -> DataFrame:
    """Events, sessions and customers per step, and the event-count
    conversion from the previous step ("10 checkouts -> 9 purchases" = 90 %).
    Every step is listed, with zeros when it has no events."""
    known = events.filter(F.col("event_type").isin(*steps))
    # Distinct counts over narrow pairs: together they would copy every event for each count.
    per_type = known.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    for column, name in (("session_id", "sessions"), ("customer_key", "customers")):
        per_type = per_type.join(distinct_count(known, ["event_type"], column, name), "event_type")
    j = _steps_frame(events, steps).join(per_type, "event_type", "left").select(
        "step_order", "event_type",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
          for c in ("events", "sessions", "customers")])
    prev = F.lag("events").over(Window.orderBy("step_order"))  # over len(steps) rows
    return j.withColumn("pct_of_previous", pct(F.col("events"), prev, 1)) \
            .orderBy("step_order")


def funnel_sessions(events: DataFrame, steps: Sequence[str] = STEPS) -> DataFrame:
    """Sessions that reach each step in order: step i counts when an event
    of that type occurs at or after the time the session reached step i-1.

    The reach times of all steps are windows over the same partitioning by
    session (the earliest event of the step at or after the time of the step
    before), so events are scanned and shuffled once, and the sessions are
    counted from the same partitioning.  Events without session are left out before
    any window, so they never meet in one task.
    """
    per_session = Window.partitionBy("session_id")
    e = events.filter(F.col("session_id").isNotNull() & F.col("event_type").isin(*steps)).select("session_id", "event_type", "event_ts")
    for i, step in enumerate(steps, start=1):
        counts = F.col("event_type") == step
        if i > 1:
            counts = counts & (F.col("event_ts") >= F.col(f"_t{i - 1}"))
        e = e.withColumn(f"_t{i}", F.min(F.when(counts, F.col("event_ts"))).over(per_session))
    reached = e.groupBy("session_id").agg(*[F.max(f"_t{i}").alias(f"_t{i}") for i in range(1, len(steps) + 1)])
    rows = F.array(*[F.struct(F.lit(i).alias("step_order"), F.col(f"_t{i}").alias("n")) for i in range(1, len(steps) + 1)])
    out = (reached.agg(*[F.count(f"_t{i}").alias(f"_t{i}") for i in range(1, len(steps) + 1)])
           .select(F.explode(rows).alias("r")).select("r.step_order", F.col("r.n").alias("sessions")))
    w = Window.orderBy("step_order")  # one row per step
    return (_steps_frame(events, steps).join(out, "step_order")
            .select(F.col("step_order").cast("long").alias("step_order"), "event_type",
                    F.col("sessions").cast("long").alias("sessions_reached"))
            .withColumn("pct_of_previous",
                        pct(F.col("sessions_reached"), F.lag("sessions_reached").over(w), 1))
            .withColumn("pct_of_first",
                        pct(F.col("sessions_reached"), F.first("sessions_reached").over(w), 1))
            .orderBy("step_order"))
