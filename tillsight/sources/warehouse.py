"""Warehouse tables: declared schemas, replace-on-rerun load and append sink.

The reference's DDL becomes ``StructType`` schemas; ``DROP ... CREATE``
becomes an overwrite, ``INSERT INTO`` an append; both cast to the declared types
and fail on NULL in a NOT NULL column.  Facts are written partitioned by order month and sorted by
customer within files, so month filters prune directories and customer
filters prune row groups by min/max statistics (the role the reference's
secondary indexes play).  Paths must be on storage every executor shares.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight import constants as C
from tillsight.session import materialize
from tillsight.sources.model import Star, first_order_keys, sum_by_product, with_first_order_flag

_MONEY = T.DecimalType(18, 2)


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# Declared schemas of the canonical tables (generated keys are long).
SCHEMAS: dict[str, T.StructType] = {
    "dim_date": T.StructType([
        _f("date_key", T.IntegerType(), False), _f("full_date", T.DateType(), False),
        _f("year", T.IntegerType(), False), _f("quarter", T.IntegerType(), False),
        _f("month", T.IntegerType(), False), _f("month_name", T.StringType(), False),
        _f("week_of_year", T.IntegerType(), False), _f("day_of_week", T.IntegerType(), False),
        _f("day_name", T.StringType(), False), _f("is_weekend", T.BooleanType(), False),
        _f("is_holiday", T.BooleanType(), False)]),
    "dim_customer": T.StructType([
        _f("customer_key", T.LongType(), False), _f("customer_id", T.StringType(), False),
        _f("first_name", T.StringType(), False), _f("last_name", T.StringType(), False),
        _f("email", T.StringType(), False), _f("country", T.StringType(), False),
        _f("city", T.StringType(), False), _f("age_band", T.StringType(), False),
        _f("acquisition_channel", T.StringType(), False),
        _f("effective_date", T.DateType(), False), _f("expiry_date", T.DateType()),
        _f("is_current", T.BooleanType(), False)]),
    "dim_product": T.StructType([
        _f("product_key", T.LongType(), False), _f("product_id", T.StringType(), False),
        _f("product_name", T.StringType(), False), _f("category", T.StringType(), False),
        _f("subcategory", T.StringType(), False), _f("brand", T.StringType(), False),
        _f("cost_price", _MONEY, False), _f("list_price", _MONEY, False),
        _f("is_active", T.BooleanType(), False)]),
    "dim_channel": T.StructType([
        _f("channel_key", T.IntegerType(), False), _f("channel_name", T.StringType(), False),
        _f("channel_type", T.StringType(), False)]),
    "fact_orders": T.StructType([
        _f("order_key", T.LongType(), False), _f("order_id", T.LongType(), False),
        _f("date_key", T.IntegerType()), _f("order_date", T.DateType()),
        _f("customer_key", T.LongType()), _f("channel_key", T.IntegerType()),
        _f("order_status", T.StringType(), False), _f("item_count", T.IntegerType(), False),
        _f("gross_revenue", _MONEY, False),
        _f("discount_amount", _MONEY), _f("net_revenue", _MONEY, False),
        _f("shipping_cost", _MONEY), _f("is_first_order", T.BooleanType(), False)]),
    "fact_order_items": T.StructType([
        _f("item_key", T.LongType(), False),
        _f("order_id", T.LongType(), False), _f("line_number", T.IntegerType()),
        _f("date_key", T.IntegerType()), _f("customer_key", T.LongType()),
        _f("product_key", T.LongType()), _f("quantity", T.IntegerType(), False),
        _f("unit_price", _MONEY, False), _f("discount_pct", T.DecimalType(5, 2)), _f("line_revenue", _MONEY, False),
        _f("line_cost", _MONEY, False), _f("line_margin", _MONEY, False)]),
    "fact_events": T.StructType([
        _f("event_key", T.LongType(), False), _f("date_key", T.IntegerType()),
        _f("customer_key", T.LongType()), _f("session_id", T.StringType(), False),
        _f("event_type", T.StringType(), False), _f("event_date", T.DateType(), False),
        _f("event_ts", T.TimestampNTZType()), _f("channel_key", T.IntegerType())]),
}

# Primary keys, string lengths and references of the declared tables.
PRIMARY_KEYS = {"dim_date": "date_key", "dim_customer": "customer_key", "dim_product": "product_key",
                "dim_channel": "channel_key", "fact_orders": "order_key", "fact_order_items": "item_key",
                "fact_events": "event_key"}
LENGTHS = {
    "dim_date": {"month_name": 20, "day_name": 10},
    "dim_customer": {"customer_id": 20, "first_name": 100, "last_name": 100, "email": 255, "country": 100, "city": 100,
                     "age_band": 20, "acquisition_channel": 50},
    "dim_product": {"product_id": 20, "product_name": 200, "category": 100, "subcategory": 100, "brand": 100},
    "dim_channel": {"channel_name": 100, "channel_type": 50},
    "fact_orders": {"order_id": 20, "order_status": 20},
    "fact_order_items": {"order_id": 20},
    "fact_events": {"session_id": 50, "event_type": 50},
}
# (child, column, parent); the parent's primary key is referenced.
REFERENCES = (
    ("fact_orders", "date_key", "dim_date"), ("fact_orders", "customer_key", "dim_customer"),
    ("fact_orders", "channel_key", "dim_channel"), ("fact_order_items", "date_key", "dim_date"),
    ("fact_order_items", "customer_key", "dim_customer"), ("fact_order_items", "product_key", "dim_product"),
    ("fact_events", "date_key", "dim_date"), ("fact_events", "customer_key", "dim_customer"),
    ("fact_events", "channel_key", "dim_channel"),
)

# Fact tables are partitioned by the month (yyyymm) of their date key.
PARTITION_COL = "month_key"
_PARTITIONED = {"fact_orders", "fact_order_items", "fact_events"}
_SORT = {"fact_orders": ["customer_key"], "fact_order_items": ["product_key"],
         "fact_events": ["session_id"]}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast the declared columns, in declared order (schema enforcement).

    As with INSERT, an omitted column takes its declared default, or NULL when
    it is nullable without one; omitting a NOT NULL column without a default
    is an error.  Values given explicitly are kept; a NULL in a NOT NULL column
    fails the job that reads it.
    """
    schema = SCHEMAS[table]
    defaults = C.COLUMN_DEFAULTS.get(table, {})
    missing = [f.name for f in schema.fields
               if f.name not in df.columns and f.name not in defaults and not f.nullable]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            src = F.col(f.name)
        else:
            src = F.lit(defaults.get(f.name))
        value = src.cast(f.dataType)
        if not f.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"{table}.{f.name} is NULL")).cast(f.dataType))
        cols.append(value.alias(f.name))
    return df.select(*cols)


def _month_of(date_key_col: str = "date_key"):
    # yyyymm from the yyyymmdd key: one integer division, no date parsing
    return (F.col(date_key_col) / 100).cast("int")


def _layout(df: DataFrame, table: str) -> tuple[DataFrame, list[str]]:
    if table not in _PARTITIONED:
        return df, []
    out = df.withColumn(PARTITION_COL, _month_of())
    # range-partition on (month, sort key): a month's rows go to few tasks,
    # but a month holding a large share of the data is split over many
    keys = [PARTITION_COL, *_SORT[table]]
    out = out.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return out, [PARTITION_COL]


def write_table(df: DataFrame, path: str, table: str, mode: str = "overwrite") -> None:
    """Write one canonical table.  ``overwrite`` replaces it (replace-on-rerun;
    with dynamic partition overwrite only the months present are replaced),
    ``append`` adds rows (INSERT INTO)."""
    if mode not in ("overwrite", "append"):
        raise ValueError(mode)
    out, parts = _layout(conform(df, table), table)
    w = out.write.mode(mode)
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(f"{path.rstrip('/')}/{table}")


def append(df: DataFrame, path: str, table: str) -> None:
    """INSERT INTO: append rows conforming to the declared schema.

    For orders ``is_first_order`` is derived, never taken from the rows: the
    new rows are flagged against the stored first orders of their customers,
    and where an appended order is earlier than a stored first order, the
    months that hold the latter are rewritten without its flag.
    """
    if table == "fact_orders":
        df = _with_flags(df, path)
    write_table(df, path, table, mode="append")


def _with_flags(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    rows = materialize(conform(df.drop("is_first_order"), "fact_orders").drop("is_first_order"))
    stored = read_table(spark, path, "fact_orders")
    theirs = rows.filter("customer_key is not null").select("customer_key").distinct()
    firsts = materialize(stored.filter("is_first_order").join(theirs, "customer_key", "left_semi").select(
        "customer_key", "order_date", "order_key", PARTITION_COL))
    columns = ["customer_key", "order_date", "order_key"]
    keys = materialize(first_order_keys(firsts.select(*columns).union(rows.select(*columns))).select(
        F.col("_first_order_key").alias("order_key"), F.lit(True).alias("_first")))
    lost = materialize(firsts.join(keys, "order_key", "left_anti").select("order_key", PARTITION_COL))
    if not lost.isEmpty():
        month = F.coalesce(PARTITION_COL, F.lit(0)).alias("_month")
        part = stored.withColumn("_month", month).join(lost.select(month).distinct(), "_month", "left_semi").drop("_month")
        part = part.join(lost.select("order_key", F.lit(True).alias("_lost")), "order_key", "left")
        fixed = part.withColumn("is_first_order", F.col("is_first_order") & F.col("_lost").isNull())
        fixed = materialize(conform(fixed, "fact_orders"))
        out, parts = _layout(fixed, "fact_orders")
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
         .parquet(f"{path.rstrip('/')}/fact_orders"))
    return rows.join(keys, "order_key", "left").withColumn(
        "is_first_order", F.col("_first").isNotNull()).drop("_first")


def load_star(star: Star, path: str, run_checks: bool = False) -> DataFrame | None:
    """Build the warehouse from the source tables (replace-on-rerun).

    ``is_first_order`` and ``item_count`` are computed here, once, at load time;
    items get their key and carry the order's date and customer keys, so they
    partition by month as well.  With ``run_checks`` the constraint (C4) and
    arithmetic (C8) checks run over the loaded tables and their rule rows are
    returned.
    """
    for table, frame in star.tables().items():
        write_table(frame, path, table)
    if not run_checks:
        return None
    from tillsight.operators import quality
    tables = quality.star_tables(WarehouseStar(star.spark, path))
    return quality.dq_checks(tables).unionByName(
        quality.order_arithmetic_check(tables["fact_orders"], tables["fact_order_items"]))


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a warehouse table; facts keep ``month_key`` (yyyymm), their
    partition column, so filters on it prune whole directories."""
    return spark.read.schema(_with_partition(table)).parquet(f"{path.rstrip('/')}/{table}")


def in_months(df: DataFrame, start, end, date_col: str = "order_date") -> DataFrame:
    """Rows of a warehouse fact with ``start <= date_col <= end``.

    The date range is also stated on ``month_key``, which Spark cannot derive
    from a date filter by itself: only the months in range are listed and
    read (partition pruning), the date filter then trims the edge months.
    """
    lo, hi = start.year * 100 + start.month, end.year * 100 + end.month
    return df.filter(F.col(PARTITION_COL).between(lo, hi)
                     & F.col(date_col).between(F.lit(start), F.lit(end)))


def _with_partition(table: str) -> T.StructType:
    schema = SCHEMAS[table]
    if table in _PARTITIONED:
        return T.StructType(schema.fields + [_f(PARTITION_COL, T.IntegerType())])
    return schema


def refresh_first_order_flag(spark: SparkSession, path: str) -> DataFrame:
    """Stored orders with ``is_first_order`` computed anew (``append`` keeps it right)."""
    return with_first_order_flag(read_table(spark, path, "fact_orders").drop("is_first_order"))


class WarehouseStar:
    """Star-schema frames read from a written warehouse (same names as ``Star``)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path, name)

    orders = property(lambda self: self._t("fact_orders"))
    orders_base = property(lambda self: self._t("fact_orders"))
    items = property(lambda self: self._t("fact_order_items"))
    products = property(lambda self: self._t("dim_product"))
    customers = property(lambda self: self._t("dim_customer"))
    channels = property(lambda self: self._t("dim_channel"))
    events = property(lambda self: self._t("fact_events"))
    dates = property(lambda self: self._t("dim_date"))
    product_totals = property(lambda self: sum_by_product(self.items))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self._t(name) for name in SCHEMAS}
