"""Calendar attributes derived from a date column.

The same expressions build ``dim_date`` (C1) and label facts directly, so a
fact never needs a join to a dense calendar to learn its month.
Conventions: ISO week of year, day of week 0 = Sunday, weekend = Sat/Sun,
English month and day names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """yyyymmdd integer key of a date."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def day_of_week_sun0(d: Column) -> Column:
    """0 = Sunday .. 6 = Saturday (Spark's dayofweek is 1 = Sunday)."""
    return (F.dayofweek(d) - 1).cast("int")


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)


def year_month(d: Column) -> Column:
    """'YYYY-MM' label of a date."""
    return F.date_format(d, "yyyy-MM")


def month_index(d: Column) -> Column:
    """year * 12 + month: month arithmetic as integer differences."""
    return (F.year(d) * 12 + F.month(d)).cast("int")


def attributes(d: Column) -> list[Column]:
    """All dim_date attribute columns for date column ``d`` (without holiday)."""
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        month_name(d).alias("month_name"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        day_of_week_sun0(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        is_weekend(d).alias("is_weekend"),
    ]
