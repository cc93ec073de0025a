"""Data-quality checks: C4 constraint checks, C8 order arithmetic checks.

Each check returns one row per rule: (rule, table_name, column_name,
checked_rows, violations).  The rules come from the declared schemas.  C4 reads each
table once and counts its keys, references and rules on rows in one shuffle.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight import constants as C
from tillsight.sources import warehouse

RESULT_COLS = ["rule", "table_name", "column_name", "checked_rows", "violations"]


def _rows_from_agg(agg: DataFrame, specs: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Unpivot a one-row aggregate into rule rows; specs = (rule, table, column, agg col).

    One explode over an array of structs, so the aggregate is computed once.
    """
    rules = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
                               F.lit(column).alias("column_name"),
                               F.col("_checked").cast("long").alias("checked_rows"),
                               F.col(src).cast("long").alias("violations"))
                      for rule, table, column, src in specs])
    return agg.select(F.explode(rules).alias("_r")).select("_r.*")


def table_rules(tables: dict[str, DataFrame], keys: dict[str, str], references: Sequence[tuple[str, str, str, str]],
                conditions: dict[str, Sequence[tuple[str, str, str]]]) -> DataFrame:
    """Unique keys, foreign keys without a parent row, and rows that break a condition, in one pass over each table.

    ``references`` has (child, column, parent, parent's key), ``conditions`` by table (rule,
    column, condition that a bad row meets, as SQL), at most 62 for a table.  Expressions are
    SQL text, since hundreds of them take seconds to build one by one.

    Every row gives one entry for each of its key columns: (domain, key, slot), where a
    domain is a parent's key column, slot 0 its own rows and the other slots the columns
    that refer to it.  Another domain of the table has the conditions that the row meets, as
    bits of its key.  Entries are counted by (domain, key), combined before the shuffle, so
    a hot key is one row for each task and the conditions a few; there a key with two rows,
    or without one, is seen without a join.
    """
    domains = {(table, key): None for table, key in keys.items()} | {(parent, key): None for _, _, parent, key in references}
    number = {d: i for i, d in enumerate(domains)}
    columns: dict[str, list[tuple[int, str, int]]] = {table: [] for table in tables}
    used: dict[int, int] = {}
    rules = []  # rule, table, column, kind, domain, slot or bit
    for table, key in domains:
        columns[table].append((number[table, key], key, 0))
    for table, key in keys.items():
        rules.append(("unique", table, key, "key", number[table, key], 0))
    for child, column, parent, key in references:
        at = number[parent, key]
        used[at] = used.get(at, 0) + 1
        columns[child].append((at, column, used[at]))
        rules.append((f"references_{key}", child, column, "reference", at, used[at]))
    whole = all(tables[t].schema[c].dataType.typeName() in ("byte", "short", "integer", "long") for t, es in columns.items() for _, c, _ in es)
    kind = "bigint" if whole else "string"
    parts = []
    for i, (table, df) in enumerate(tables.items()):
        entries = [f"{d}, cast(`{c}` as {kind}), {k}" for d, c, k in columns[table]]
        if met := conditions.get(table):
            at = len(domains) + i
            bits = " + ".join(f"if({bad}, {1 << bit}L, 0L)" for bit, (_, _, bad) in enumerate(met))
            entries.append(f"{at}, cast({bits} as {kind}), 0")
            rules += [(rule, table, column, "condition", at, bit) for bit, (rule, column, _) in enumerate(met)]
        if entries:
            parts.append(df.selectExpr(f"stack({len(entries)}, {', '.join(entries)}) as (domain, key, slot)"))
    slots = range(max([0, *used.values()]) + 1)
    most = max([0, *map(len, conditions.values())])
    counted = functools.reduce(DataFrame.union, parts).groupBy("domain", "key").agg(
        *[F.expr(f"count_if(slot = {k}) as n{k}") for k in slots])
    found = counted.groupBy("domain", F.expr(f"if(domain >= {len(domains)}, cast(key as bigint), null) as bits")).agg(
        F.expr("sum(if(key is null or n0 > 1, n0, 0)) as doubled"),
        *[F.expr(f"sum(n{k}) as rows{k}") for k in slots],
        *[F.expr(f"sum(if(key is not null and n0 = 0, n{k}, 0)) as orphans{k}") for k in slots])
    # one row for each domain: sums of its sets of conditions, then all domains as one map beside the fixed list of rules
    met_sums = ", ".join(f"sum(if(bits & {1 << bit}L <> 0, rows0, 0L))" for bit in range(most))
    found = found.groupBy("domain").agg(
        F.expr("sum(doubled) as doubled"), F.expr(f"cast(array({met_sums}) as array<bigint>) as met"),
        *[F.expr(f"array({', '.join(f'sum({name}{k})' for k in slots)}) as {name}") for name in ("rows", "orphans")])
    totals = found.selectExpr("map_from_entries(collect_list(struct(domain, struct(doubled, met, rows, orphans)))) as m")
    listed = ", ".join(f"struct('{rule}' as rule, '{table}' as table_name, '{column}' as column_name, '{of}' as kind, {at} as at, {place} as place)"
                       for rule, table, column, of, at, place in rules)
    return totals.selectExpr("m", f"inline(array({listed}))").selectExpr(
        "rule", "table_name", "column_name",
        "coalesce(get(m[at].rows, if(kind = 'reference', place, 0)), 0L) as checked_rows",
        "coalesce(case kind when 'key' then m[at].doubled when 'reference' then get(m[at].orphans, place) else get(m[at].met, place) end, 0L)"
        " as violations")


def overlapping_versions(versions: DataFrame, table: str, natural_key: str, surrogate_key: str) -> DataFrame:
    """Versions that begin before an earlier one of the same natural key has ended (windows hold one key's versions)."""
    before = Window.partitionBy(natural_key).orderBy("effective_date", surrogate_key).rowsBetween(Window.unboundedPreceding, -1)
    ends = F.max(F.coalesce("expiry_date", F.lit("9999-12-31").cast("date"))).over(before)
    meets = F.coalesce((ends > F.col("effective_date")) & F.col(natural_key).isNotNull(), F.lit(False))
    agg = versions.select(meets.alias("_meets")).agg(F.count(F.lit(1)).alias("_checked"), F.count_if("_meets").alias("_bad"))
    return _rows_from_agg(agg, [("versions_do_not_overlap", table, natural_key, "_bad")])


def star_tables(star) -> dict[str, DataFrame]:
    """The seven tables of a star, as declared."""
    return star.tables()


def dq_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """C4: all declared keys, NOT NULLs, lengths, defaults and references as checks, the order statuses, the
    items' link to orders by order_id (which is not declared), and that a customer's versions do not overlap.

    One pass over each table and one shuffle serve all of them but the last.  A column with
    a declared DEFAULT that is NULL was not filled.
    """
    references = [(child, column, parent, warehouse.PRIMARY_KEYS[parent]) for child, column, parent in warehouse.REFERENCES]
    references.append(("fact_order_items", "order_id", "fact_orders", "order_id"))
    conditions = {}
    for table, schema in warehouse.SCHEMAS.items():
        key = warehouse.PRIMARY_KEYS[table]
        rules = [("not_null", f.name, f"`{f.name}` is null") for f in schema.fields if not f.nullable and f.name != key]
        rules += [(f"max_length_{n}", c, f"length(cast(`{c}` as string)) > {n}") for c, n in warehouse.LENGTHS[table].items()]
        rules += [("default_filled", c, f"`{c}` is null") for c in C.COLUMN_DEFAULTS.get(table, {})]
        if table == "fact_orders":
            allowed = ", ".join(f"'{x}'" for x in C.ORDER_STATUSES)
            rules.append(("allowed_values", "order_status", f"order_status not in ({allowed})"))
        conditions[table] = rules
    return table_rules(tables, warehouse.PRIMARY_KEYS, references, conditions).unionByName(
        overlapping_versions(tables["dim_customer"], "dim_customer", "customer_id", "customer_key")).select(*RESULT_COLS)


def order_arithmetic_check(orders: DataFrame, items: DataFrame) -> DataFrame:
    """net = gross - discount per order, margin = revenue - cost per line,
    item_count = lines of the order, and no order without a line."""
    lines = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("_lines"))
    o_agg = orders.join(lines, "order_id", "left").agg(
        F.count(F.lit(1)).alias("_checked"),
        F.count_if(F.col("net_revenue") != F.col("gross_revenue")
                   - F.coalesce(F.col("discount_amount"), F.lit(0))).alias("_net"),
        F.count_if(F.col("item_count") != F.coalesce("_lines", F.lit(0))).alias("_count"),
        F.count_if(F.col("_lines").isNull()).alias("_none"))
    i_agg = items.agg(
        F.count(F.lit(1)).alias("_checked"),
        F.count_if(F.col("line_margin") != F.col("line_revenue") - F.col("line_cost")).alias("_bad"))
    return (_rows_from_agg(o_agg, [("net_equals_gross_minus_discount", "fact_orders", "net_revenue", "_net"),
                                   ("item_count_equals_lines", "fact_orders", "item_count", "_count"),
                                   ("order_has_lines", "fact_orders", "order_id", "_none")])
            .unionByName(_rows_from_agg(i_agg, [("margin_equals_revenue_minus_cost",
                                                 "fact_order_items", "line_margin", "_bad")]))
            .select(*RESULT_COLS))
