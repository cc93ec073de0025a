"""DuckDB SQL that must give the same rows as the registered queries.

Written from the definitions of the analytics, over the raw generated tables, by
other methods than the Spark jobs: sorted lists of a customer's days instead of row
numbers, a customer-by-month grid of presence instead of joins of activity, counts
of better-placed rows instead of ranking functions, look-ups per customer instead of
grouped joins.  Nothing is imported from the code under test; every value a result
depends on is written here.

Rounded ratios use integer arithmetic, since DuckDB turns decimal division into
DOUBLE: round_half_up(N / D, s) = (2 * |N| * 10^s + |D|) // (2 * |D|) / 10^s
"""

from __future__ import annotations


def hu(num: str, den: str, s: int, num_scale: int = 2, den_scale: int = 2) -> str:
    """SQL for round(num / den, s) half away from zero, as DOUBLE; NULL if den = 0.

    ``num``/``den`` are exact numbers with at most ``*_scale`` decimals.
    """
    n = f"(CAST(({num}) * {10 ** num_scale} AS HUGEINT) * {10 ** den_scale})"
    d = f"(CAST(({den}) * {10 ** den_scale} AS HUGEINT) * {10 ** num_scale})"
    q = f"((2 * abs({n}) * {10 ** s} + abs({d})) // (2 * abs({d})))"
    v = f"(CAST({q} AS DOUBLE) / CAST({10 ** s} AS DOUBLE))"
    return (f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 OR ({num}) IS NULL THEN NULL "
            f"WHEN (({n}) < 0) <> (({d}) < 0) AND {q} > 0 THEN -{v} ELSE {v} END)")


def pct(part: str, whole: str, s: int = 1, part_scale: int = 2, whole_scale: int = 2) -> str:
    return hu(f"({part}) * 100", whole, s, part_scale, whole_scale)


def _id(prefix: str, key: str) -> str:
    """Prefix and key with at least six digits."""
    return f"'{prefix}' || repeat('0', greatest(6 - length({key}::VARCHAR), 0)) || {key}::VARCHAR"


PRELUDE = f"""
calendar AS (
  SELECT unnest(generate_series(min(o_orderdate)::DATE::TIMESTAMP, max(o_orderdate)::DATE::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day
  FROM orders),
sale AS (
  SELECT o_orderkey AS okey, o_custkey AS who, o_orderdate::DATE AS day, o_totalprice::DECIMAL(18,2) AS money,
         map {{'F': 'completed', 'P': 'cancelled', 'O': 'refunded'}}[o_orderstatus] AS status,
         o_orderpriority AS priority
  FROM orders),
opening AS (  -- each customer's first order of any status
  SELECT list(okey ORDER BY day NULLS LAST, okey)[1] AS okey FROM sale WHERE who IS NOT NULL GROUP BY who),
flagged AS (SELECT *, okey IN (SELECT okey FROM opening) AS opens FROM sale),
done AS (  -- completed orders on days of the calendar
  SELECT f.* FROM flagged f JOIN calendar USING (day) WHERE status = 'completed'),
good AS (
  SELECT p_partkey AS pkey, p_name AS title, p_type AS kind, p_brand AS brand, p_retailprice::DECIMAL(18,2) AS cost FROM part),
line AS (
  SELECT l_orderkey AS okey, l_partkey AS pkey, l_quantity::INTEGER AS qty,
         (l_discount::DECIMAL(4,2) * 100)::DECIMAL(5,2) AS off,
         round(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(4,2)), 2)::DECIMAL(18,2) AS rev
  FROM lineitem),
costed AS (SELECT line.*, (qty * cost)::DECIMAL(18,2) AS cost, (rev - (qty * cost)::DECIMAL(18,2))::DECIMAL(18,2) AS gain
           FROM line LEFT JOIN good USING (pkey)),
person AS (
  SELECT c_custkey AS who, {_id('C', 'c_custkey')} AS cid, c_name AS first_name, n_name AS country,
         c_name || ' ' || n_name AS full_name, lower(c_mktsegment) AS segment,
         ['18-24', '25-34', '35-44', '45-54', '55+'][1 + (c_acctbal >= 0)::INT + (c_acctbal >= 2500)::INT
            + (c_acctbal >= 5000)::INT + (c_acctbal >= 7500)::INT] AS ages
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
visit AS (
  SELECT event_id AS ekey, user_id AS who, ts, ts::DATE AS day,
         user_id::VARCHAR || '-' || strftime(ts::DATE, '%Y%m%d') AS sid,
         coalesce(map {{'view': 'pageview', 'click': 'add_to_cart', 'signup': 'checkout', 'purchase': 'purchase'}}[event_type],
                  event_type) AS step
  FROM events)
"""

MONTHS = ("['January', 'February', 'March', 'April', 'May', 'June', 'July', 'August', 'September', 'October', "
          "'November', 'December']")


def _q(body: str) -> str:
    """Attach the shared views; ``body`` may start with more of them."""
    body = body.strip()
    joint = "" if body.upper().startswith("SELECT") else ","
    return f"WITH {PRELUDE}{joint} {body}"


ORACLE: dict[str, str] = {}

# A1: the month before is the greatest smaller month that has orders.
ORACLE["q01_monthly_revenue_mom"] = _q(f"""
m AS (
  SELECT month(day) AS mo, sum(money) AS rev, count(money) AS n, len(list_distinct(list(okey))) AS orders_,
         len(list_distinct(list(who))) AS people
  FROM done GROUP BY mo),
b AS (SELECT m.mo, arg_max(p.rev, p.mo) AS prev FROM m LEFT JOIN m p ON p.mo < m.mo GROUP BY m.mo)
SELECT {MONTHS}[mo] AS month_name, orders_::BIGINT AS total_orders, people::BIGINT AS unique_customers,
       rev::DOUBLE AS net_revenue, {hu('rev', 'n', 2, 2, 0)} AS avg_order_value, prev::DOUBLE AS prev_month_revenue,
       {pct('rev - prev', 'prev', 1)} AS mom_growth_pct
FROM m JOIN b USING (mo)
""")

# A2: products first, then their categories.
ORACLE["q02_category_margin"] = _q(f"""
p AS (SELECT pkey, sum(qty) AS qty, sum(rev) AS rev, sum(cost) AS cost, sum(gain) AS gain FROM costed GROUP BY pkey),
k AS (SELECT kind, sum(qty) AS qty, sum(rev) AS rev, sum(p.cost) AS cost, sum(gain) AS gain FROM good JOIN p USING (pkey) GROUP BY kind),
seen AS (SELECT kind, count(*) AS n FROM (SELECT DISTINCT kind, okey FROM line JOIN good USING (pkey)) GROUP BY kind)
SELECT kind AS category, n AS orders, qty::BIGINT AS units_sold, rev::DOUBLE AS revenue, cost::DOUBLE AS cost,
       gain::DOUBLE AS gross_margin, {pct('gain', 'rev', 1)} AS margin_pct
FROM k JOIN seen USING (kind)
""")

# A3: a product's rank is one more than the number of products with more revenue.
ORACLE["q03_top_products"] = _q(f"""
p AS (SELECT pkey, sum(qty) AS qty, sum(rev) AS rev, sum(gain) AS gain, sum(off) AS off, count(off) AS n
      FROM costed WHERE pkey IN (SELECT pkey FROM good) GROUP BY pkey),
r AS (SELECT a.pkey, 1 + count(b.pkey) AS place FROM p a LEFT JOIN p b ON b.rev > a.rev GROUP BY a.pkey)
SELECT place AS revenue_rank, title AS product_name, kind AS category, brand, qty::BIGINT AS units_sold,
       rev::DOUBLE AS revenue, gain::DOUBLE AS gross_margin, {hu('off', 'n', 1, 2, 0)} AS avg_discount_pct
FROM p JOIN r USING (pkey) JOIN good USING (pkey) ORDER BY place, pkey LIMIT 10
""")

# A4: look-ups per customer; kept are customers without orders, and those with a completed one.
ORACLE["q04_customer_ltv"] = _q(f"""
own AS (
  SELECT who, count(*) AS every, list(struct_pack(okey := okey, day := day, money := money))
           FILTER (coalesce(status, 'completed') = 'completed') AS mine
  FROM sale WHERE who IS NOT NULL GROUP BY who),
card AS (
  SELECT p.*, every, coalesce(len(mine), 0) AS rows_, list_transform(mine, lambda x: x.okey) AS keys,
         list_transform(mine, lambda x: x.day) AS days, list_transform(mine, lambda x: x.money) AS sums
  FROM person p LEFT JOIN own USING (who)),
f AS (
  SELECT *, list_sum(sums)::DECIMAL(38,2) AS ltv, list_count(sums) AS n FROM card WHERE every IS NULL OR rows_ > 0)
SELECT cid AS customer_id, full_name AS customer_name, country, ages AS age_band, segment AS acquisition_channel,
       coalesce(len(list_distinct(keys)), 0)::BIGINT AS total_orders, ltv::DOUBLE AS lifetime_value,
       {hu('ltv', 'n', 2, 2, 0)} AS avg_order_value, list_min(days) AS first_order_date, list_max(days) AS last_order_date,
       CASE WHEN coalesce(ltv, 0) <= 0 THEN 'no_purchase' WHEN ltv < 500 THEN 'low_value' WHEN ltv < 1500 THEN 'mid_value'
            ELSE 'high_value' END AS ltv_segment
FROM f
""")

# A5: revenue split by the flag as a number.
ORACLE["q05_new_vs_returning"] = _q(f"""
m AS (SELECT month(day) AS mo, sum(money * opens::INT) AS new, sum(money * (NOT opens)::INT) AS old, sum(money) AS rev
      FROM done GROUP BY mo)
SELECT {MONTHS}[mo] AS month_name, coalesce(new, 0)::DOUBLE AS new_customer_rev, coalesce(old, 0)::DOUBLE AS returning_rev,
       rev::DOUBLE AS total_revenue, {pct('coalesce(old, 0)', 'rev', 1)} AS returning_pct
FROM m
""")

# A customer's days as a sorted list.
ORACLE["q06_days_to_second_order"] = _q("""
d AS (SELECT who, list(day ORDER BY day) AS days FROM done WHERE who IS NOT NULL GROUP BY who),
g AS (SELECT who, days[1] AS a, days[2] AS b, days[2] - days[1] AS gap FROM d WHERE len(days) > 1)
SELECT who AS customer_key, a AS first_order_date, b AS second_order_date, gap::BIGINT AS days_between_orders,
       ['0-30 days', '31-60 days', '61-90 days', '90+ days'][1 + (gap > 30)::INT + (gap > 60)::INT + (gap > 90)::INT] AS repeat_bucket
FROM g
""")

ORACLE["q09_day_retention"] = _q(f"""
d AS (SELECT who, list_sort(list_distinct(list(day))) AS days FROM done GROUP BY who),
g AS (SELECT CASE WHEN who IS NOT NULL THEN days[2] - days[1] END AS gap FROM d),
n AS (SELECT count(*) AS everyone, count(*) FILTER (gap <= 30) AS a, count(*) FILTER (gap <= 60) AS b,
             count(*) FILTER (gap <= 90) AS c FROM g)
SELECT everyone AS total_customers, a AS retained_30d, b AS retained_60d, c AS retained_90d,
       {pct('a', 'everyone', 1, 0, 0)} AS d30_pct, {pct('b', 'everyone', 1, 0, 0)} AS d60_pct, {pct('c', 'everyone', 1, 0, 0)} AS d90_pct
FROM n
""")

# A grid of customers by month, ticked where a completed order stands.
_GRID = """
month_of AS (SELECT who, okey, opens, status, year(day) * 12 + month(day) - 1 AS ym FROM flagged JOIN calendar USING (day)
             WHERE who IS NOT NULL),
starts AS (SELECT who, min(ym) AS c FROM month_of WHERE opens GROUP BY who),
ticks AS (SELECT DISTINCT who, ym FROM month_of WHERE status = 'completed'),
span AS (SELECT unnest(range(0, (SELECT max(ym) - min(ym) + 1 FROM month_of)::BIGINT)) AS k),
grid AS (SELECT who, c, k, (who, c + k) IN (SELECT (who, ym) FROM ticks) AS there FROM starts, span),
born AS (SELECT c, count(*) AS people FROM starts GROUP BY c),
cells AS (SELECT c, k, count(*) FILTER (there) AS n FROM grid GROUP BY c, k)
"""
_YM = "(c // 12)::VARCHAR || '-' || lpad((c % 12 + 1)::VARCHAR, 2, '0')"

ORACLE["q07_cohort_retention"] = _q(_GRID + f"""
SELECT {_YM} AS cohort_month, people AS cohort_users, k AS months_since_first, n AS active_users,
       {pct('n', 'people', 1, 0, 0)} AS retention_pct
FROM cells JOIN born USING (c) WHERE n > 0
""")

ORACLE["q08_cohort_matrix"] = _q(_GRID + """,
wide AS (SELECT c, list(n ORDER BY k) AS n, sum(n) AS any_ FROM cells GROUP BY c)
SELECT """ + f"{_YM} AS cohort_month, people AS cohort_users, n[1] AS m0, " + ", ".join(
    f"{pct(f'coalesce(n[{i + 1}], 0)', 'people', 0, 0, 0)} AS m{i}_pct" for i in range(1, 5)) + """
FROM wide JOIN born USING (c) WHERE any_ > 0
""")

# Look-ups per customer among completed, dated orders.
_SPEND = """
bag AS (SELECT who, max(day) AS last_day, len(list_distinct(list(okey))) AS n, sum(money) AS spent, count(money) AS paid
        FROM done GROUP BY who),
spender AS (SELECT p.cid, p.full_name, p.country, last_day, n, spent, DATE '2001-08-31' - last_day AS idle
            FROM person p, bag b WHERE b.who = p.who AND paid > 0)
"""
ORACLE["q10_churn_status"] = _q(_SPEND + """
SELECT cid AS customer_id, full_name AS customer_name, country, last_day AS last_order_date, n::BIGINT AS total_orders,
       spent::DOUBLE AS total_spent, idle::BIGINT AS days_since_last_order,
       ['active', 'cooling', 'at_risk', 'churned'][1 + (idle > 30)::INT + (idle > 60)::INT + (idle > 90)::INT] AS churn_status
FROM spender
""")

# Days are numbered by counting, windows are joins on those numbers.
ORACLE["q11_rolling_revenue"] = _q(f"""
d AS (SELECT day, sum(money) AS rev, count(DISTINCT okey) AS n FROM done GROUP BY day),
i AS (SELECT a.day, count(*) AS at, sum(b.rev) AS running FROM d a JOIN d b ON b.day <= a.day GROUP BY a.day),
w AS (SELECT a.day, sum(d.rev) AS rev, count(d.rev) AS n
      FROM i a JOIN i b ON b.at BETWEEN a.at - 6 AND a.at JOIN d ON d.day = b.day GROUP BY a.day)
SELECT day AS full_date, d.rev::DOUBLE AS daily_revenue, d.n AS daily_orders, {hu('w.rev', 'w.n', 2, 2, 0)} AS rolling_7d_avg,
       running::DOUBLE AS cumulative_revenue
FROM d JOIN i USING (day) JOIN w USING (day)
""")


def _tile(place: str, total: str) -> str:
    """NTILE(5) of a place: the first ``total % 5`` tiles have one more row."""
    small, more = f"({total} // 5)", f"({total} % 5)"
    return (f"(1 + CASE WHEN {place} <= {more} * ({small} + 1) THEN ({place} - 1) // ({small} + 1) "
            f"ELSE {more} + ({place} - 1 - {more} * ({small} + 1)) // greatest({small}, 1) END)")


# A place is one more than the number of better-placed customers.
ORACLE["q12_pareto_quintiles"] = _q(f"""
v AS (SELECT who, sum(money) AS worth FROM flagged WHERE status = 'completed' GROUP BY who),
s AS (SELECT count(*) AS total, sum(worth) AS money FROM v),
p AS (SELECT a.who, any_value(a.worth) AS worth, 1 + count(b.worth) AS place
      FROM v a LEFT JOIN v b ON b.worth > a.worth OR (b.worth = a.worth AND coalesce(b.who, -1) < coalesce(a.who, -1))
      GROUP BY a.who),
t AS (SELECT {_tile('place', 'total')} AS tile, worth, money FROM p, s)
SELECT tile::BIGINT AS quintile, count(*) AS customers, sum(worth)::DOUBLE AS revenue,
       {pct('sum(worth)', 'any_value(money)', 1)} AS pct_of_revenue
FROM t GROUP BY tile
""")

# An order's lines as a list; pairs of places in it with a smaller and a greater product.
ORACLE["q13_product_affinity"] = _q("""
b AS (SELECT list(pkey) AS ps FROM line GROUP BY okey),
i AS (SELECT ps, unnest(ps) AS x FROM b),
j AS (SELECT x, unnest(ps) AS y FROM i),
c AS (SELECT x, y, count(*) AS n FROM j WHERE x < y GROUP BY x, y)
SELECT g.title AS product_a, h.title AS product_b, sum(n)::BIGINT AS times_bought_together
FROM c JOIN good g ON g.pkey = x JOIN good h ON h.pkey = y GROUP BY 1, 2
ORDER BY 3 DESC, 1, 2 LIMIT 15
""")


def _places(name: str, better: str) -> str:
    return (f"{name} AS (SELECT a.cid, 1 + count(b.cid) AS place FROM spender a LEFT JOIN spender b "
            f"ON {better} GROUP BY a.cid)")


ORACLE["q14_rfm_segments"] = _q(_SPEND + ",\n" + ",\n".join([
    _places("pr", "b.idle < a.idle OR (b.idle = a.idle AND b.cid < a.cid)"),
    _places("pf", "b.n > a.n OR (b.n = a.n AND b.cid < a.cid)"),
    _places("pm", "b.spent > a.spent OR (b.spent = a.spent AND b.cid < a.cid)")]) + f""",
all_ AS (SELECT count(*) AS total FROM spender),
t AS (SELECT s.*, {_tile('pr.place', 'total')} AS r, {_tile('pf.place', 'total')} AS f, {_tile('pm.place', 'total')} AS m
      FROM spender s JOIN pr USING (cid) JOIN pf USING (cid) JOIN pm USING (cid), all_)
SELECT cid AS customer_id, full_name AS customer_name, last_day AS last_order_date, idle::BIGINT AS recency_days,
       n::BIGINT AS frequency, spent::DOUBLE AS monetary, r::BIGINT AS r_score, f::BIGINT AS f_score, m::BIGINT AS m_score,
       {hu('r + f + m', '3', 1, 0, 0)} AS rfm_score,
       -- by r: row r of the table, by f: its column
       [['Lost', 'Lost', 'At Risk', 'At Risk', 'At Risk'], ['Lost', 'Lost', 'At Risk', 'At Risk', 'At Risk'],
        ['Potential', 'Potential', 'Loyal', 'Loyal', 'Loyal'], ['Recent', 'Recent', 'Loyal', 'Champions', 'Champions'],
        ['Recent', 'Recent', 'Loyal', 'Champions', 'Champions']][r][f] AS rfm_segment
FROM t
""")

# One row for each status, one for each customer, put together.
ORACLE["q15_executive_dashboard"] = _q(f"""
st AS (SELECT status, count(*) AS n, sum(money) AS rev, count(money) AS paid, len(list_distinct(list(okey))) AS orders_
       FROM sale GROUP BY status),
by_status AS (
  SELECT sum(n) AS everything, max(rev) FILTER (status = 'completed') AS rev, max(paid) FILTER (status = 'completed') AS paid,
         coalesce(max(orders_) FILTER (status = 'completed'), 0) AS orders_,
         coalesce(max(n) FILTER (status = 'refunded'), 0) AS back, coalesce(max(n) FILTER (status = 'cancelled'), 0) AS off
  FROM st),
people AS (SELECT count(*) AS n, count(*) FILTER (new) AS fresh
           FROM (SELECT who, bool_or(opens) AS new FROM flagged WHERE who IS NOT NULL GROUP BY who)),
best AS (SELECT kind FROM good JOIN (SELECT pkey, sum(rev) AS rev FROM line GROUP BY pkey) USING (pkey)
         GROUP BY kind ORDER BY sum(rev) DESC, kind LIMIT 1)
SELECT rev::DOUBLE AS total_net_revenue, orders_::BIGINT AS total_orders, people.n AS total_customers, fresh AS new_customers,
       people.n - fresh AS returning_customers, {hu('rev', 'paid', 2, 2, 0)} AS avg_order_value, kind AS top_category,
       {pct('back', 'everything', 1, 0, 0)} AS refund_rate_pct, {pct('off', 'everything', 1, 0, 0)} AS cancel_rate_pct
FROM by_status, people, best
""")

ORACLE["c7_category_margin_share"] = _q(f"""
k AS (SELECT kind, sum(gain) AS gain, len(list_distinct(list(okey))) AS n FROM costed JOIN good USING (pkey) GROUP BY kind),
whole AS (SELECT (SELECT sum(gain) FROM k) AS gain,
                 (SELECT count(*) FROM (SELECT DISTINCT okey FROM line WHERE pkey IN (SELECT pkey FROM good))) AS n)
SELECT kind AS category, k.gain::DOUBLE AS gross_margin, {pct('k.gain', 'whole.gain', 1)} AS margin_share_pct,
       k.n::BIGINT AS orders, {pct('k.n', 'whole.n', 1, 0, 0)} AS order_share_pct
FROM k, whole
""")

ORACLE["c1_dim_date"] = _q("""
SELECT strftime(day, '%Y%m%d')::INTEGER AS date_key, day AS full_date, year(day)::INTEGER AS year, quarter(day)::INTEGER AS quarter,
       month(day)::INTEGER AS month, strftime(day, '%B') AS month_name, weekofyear(day)::INTEGER AS week_of_year,
       dayofweek(day)::INTEGER AS day_of_week, strftime(day, '%A') AS day_name, dayofweek(day) IN (0, 6) AS is_weekend,
       strftime(day, '%m%d') = '0101' AS is_holiday
FROM calendar
""")

ORACLE["c2_first_order_flag"] = _q("""
SELECT okey AS order_id, who AS customer_key, day AS order_date, opens AS is_first_order FROM flagged
""")

# The snapshot is the first order's channel as of 2001-09-01.
ORACLE["c3_scd2_apply"] = _q(f"""
dim AS (SELECT who, cid, first_name, country, lower(replace(first_name, '#', '.')) || '@example.com' AS email, ages, segment FROM person),
snap AS (SELECT {_id('C', 'who')} AS cid, 'channel-' || priority[1:1] AS channel FROM flagged WHERE opens),
met AS (SELECT coalesce(dim.cid, snap.cid) AS cid, who, first_name, country, email, ages, segment, channel,
               snap.cid IS NOT NULL AND (who IS NULL OR segment IS DISTINCT FROM channel) AS moved
        FROM dim FULL JOIN snap ON dim.cid = snap.cid),
fresh AS (SELECT m.cid, count(*) AS pos FROM met m JOIN met b ON b.moved AND b.cid <= m.cid WHERE m.moved GROUP BY m.cid)
SELECT who AS customer_key, cid AS customer_id, first_name, country AS last_name, email, country, country AS city, ages AS age_band,
       segment AS acquisition_channel, DATE '1992-01-01' AS effective_date,
       CASE WHEN moved THEN DATE '2001-09-01' END AS expiry_date, NOT moved AS is_current
FROM met WHERE who IS NOT NULL
UNION ALL
SELECT (SELECT max(who) FROM dim) + pos, cid, first_name, country, email, country, country, ages, channel, DATE '2001-09-01', NULL, TRUE
FROM met JOIN fresh USING (cid)
""")

_TABLES = """
t_dim_date AS (SELECT strftime(day, '%Y%m%d')::INTEGER AS date_key, day AS full_date, year(day) AS year, quarter(day) AS quarter,
  month(day) AS month, strftime(day, '%B') AS month_name, weekofyear(day) AS week_of_year, dayofweek(day) AS day_of_week,
  strftime(day, '%A') AS day_name, TRUE AS is_weekend, TRUE AS is_holiday FROM calendar),
t_dim_customer AS (SELECT who AS customer_key, cid AS customer_id, first_name, country AS last_name,
  lower(replace(first_name, '#', '.')) || '@example.com' AS email, country, country AS city, ages AS age_band,
  segment AS acquisition_channel, DATE '1992-01-01' AS effective_date, NULL::DATE AS expiry_date, TRUE AS is_current FROM person),
t_dim_product AS (SELECT pkey AS product_key, """ + _id("P", "pkey") + """ AS product_id, title AS product_name, kind AS category,
  p_type || ' ' || p_size::VARCHAR AS subcategory, brand, cost AS cost_price, cost AS list_price, TRUE AS is_active
  FROM good JOIN part ON p_partkey = pkey),
t_dim_channel AS (SELECT DISTINCT o_orderpriority[1:1]::INTEGER AS channel_key, o_orderpriority AS channel_name,
  'priority' AS channel_type FROM orders),
lines_of AS (SELECT okey, count(*) AS n FROM line GROUP BY okey),
t_fact_orders AS (SELECT okey AS order_key, okey AS order_id, strftime(day, '%Y%m%d')::INTEGER AS date_key, who AS customer_key,
  priority[1:1]::INTEGER AS channel_key, status AS order_status, coalesce(n, 0) AS item_count, money AS gross_revenue,
  money AS net_revenue, 0 AS discount_amount, 0 AS shipping_cost, opens AS is_first_order, n AS lines FROM flagged LEFT JOIN lines_of USING (okey)),
t_fact_order_items AS (SELECT row_number() OVER () AS item_key, c.okey AS order_id, date_key, customer_key, pkey AS product_key,
  qty AS quantity, rev AS unit_price, off AS discount_pct, rev AS line_revenue, cost AS line_cost, gain AS line_margin
  FROM costed c LEFT JOIN t_fact_orders o ON o.order_key = c.okey),
t_fact_events AS (SELECT ekey AS event_key, strftime(day, '%Y%m%d')::INTEGER AS date_key, who AS customer_key, sid AS session_id,
  step AS event_type, day AS event_date, NULL::INTEGER AS channel_key FROM visit)
"""

# The declared schema: primary key, NOT NULL columns, lengths, references; fixed values.
_DECLARED = {
    "dim_date": ("date_key", "full_date year quarter month month_name week_of_year day_of_week day_name is_weekend is_holiday",
                 "month_name=20 day_name=10", ""),
    "dim_customer": ("customer_key", "customer_id first_name last_name email country city age_band acquisition_channel "
                     "effective_date is_current", "customer_id=20 first_name=100 last_name=100 email=255 country=100 city=100 "
                     "age_band=20 acquisition_channel=50", ""),
    "dim_product": ("product_key", "product_id product_name category subcategory brand cost_price list_price is_active",
                    "product_id=20 product_name=200 category=100 subcategory=100 brand=100", ""),
    "dim_channel": ("channel_key", "channel_name channel_type", "channel_name=100 channel_type=50", ""),
    "fact_orders": ("order_key", "order_id order_status item_count gross_revenue net_revenue is_first_order",
                    "order_id=20 order_status=20", "date_key=dim_date customer_key=dim_customer channel_key=dim_channel"),
    "fact_order_items": ("item_key", "order_id quantity unit_price line_revenue line_cost line_margin", "order_id=20",
                         "date_key=dim_date customer_key=dim_customer product_key=dim_product"),
    "fact_events": ("event_key", "session_id event_type event_date", "session_id=50 event_type=50",
                    "date_key=dim_date customer_key=dim_customer channel_key=dim_channel"),
}

#: Columns with a declared DEFAULT.
_DEFAULTED = {"dim_date": "is_weekend is_holiday", "dim_customer": "is_current", "dim_product": "is_active",
              "fact_orders": "discount_amount shipping_cost is_first_order", "fact_order_items": "discount_pct"}


def _rule(rule: str, table: str, column: str, violations: str) -> str:
    return (f"SELECT '{rule}' AS rule, '{table}' AS table_name, '{column}' AS column_name, "
            f"(SELECT count(*) FROM t_{table}) AS checked_rows, ({violations})::BIGINT AS violations")


def _declared_rules() -> list[str]:
    out = []
    for table, (key, required, lengths, references) in _DECLARED.items():
        out.append(_rule("unique", table, key, f"SELECT count(*) FROM t_{table} WHERE {key} IS NULL OR {key} IN "
                         f"(SELECT {key} FROM t_{table} GROUP BY {key} HAVING count(*) > 1)"))
        out += [_rule("not_null", table, c, f"SELECT count(*) - count({c}) FROM t_{table}") for c in required.split()]
        for c, n in (x.split("=") for x in lengths.split()):
            out.append(_rule(f"max_length_{n}", table, c, f"SELECT count(*) FROM t_{table} WHERE length({c}::VARCHAR) > {n}"))
        for c, parent in (x.split("=") for x in references.split()):
            pk = _DECLARED[parent][0]
            out.append(_rule(f"references_{pk}", table, c, f"SELECT count(*) FROM t_{table} WHERE {c} NOT IN (SELECT {pk} FROM t_{parent})"))
    out.append(_rule("references_order_id", "fact_order_items", "order_id",
                     "SELECT count(*) FROM t_fact_order_items WHERE order_id NOT IN (SELECT order_id FROM t_fact_orders)"))
    for table, columns in _DEFAULTED.items():
        out += [_rule("default_filled", table, c, f"SELECT count(*) - count({c}) FROM t_{table}") for c in columns.split()]
    # a version that another of the same customer meets: it begins before the other ends and the other before it ends
    out.append(_rule("versions_do_not_overlap", "dim_customer", "customer_id", """
      SELECT count(*) FROM t_dim_customer a WHERE EXISTS (SELECT 1 FROM t_dim_customer b
        WHERE b.customer_id = a.customer_id AND (b.effective_date, b.customer_key) < (a.effective_date, a.customer_key)
          AND coalesce(b.expiry_date, DATE '9999-12-31') > a.effective_date)"""))
    out.append(_rule("allowed_values", "fact_orders", "order_status",
                     "SELECT count(*) FROM t_fact_orders WHERE order_status NOT IN ('completed', 'refunded', 'cancelled')"))
    return out


ORACLE["c4_dq_checks"] = _q(_TABLES + "\nUNION ALL\n".join(_declared_rules()))

ORACLE["c5_surrogate_keys"] = _q("""
ids AS (SELECT list_sort(list_distinct(list(sid))) AS sids FROM visit)
SELECT unnest(sids) AS session_id, unnest(range(1, len(sids) + 1)) AS session_key FROM ids
""")

_STEPS = "steps AS (SELECT unnest(['pageview', 'add_to_cart', 'checkout', 'purchase']) AS step, unnest([1, 2, 3, 4]) AS pos)"

ORACLE["c6_funnel_counts"] = _q(_STEPS + f""",
n AS (SELECT pos, step, count(ekey) AS events_, len(list_distinct(list(sid) FILTER (sid IS NOT NULL))) AS sessions,
             len(list_distinct(list(who) FILTER (who IS NOT NULL))) AS people
      FROM steps LEFT JOIN visit USING (step) GROUP BY pos, step)
SELECT a.pos::BIGINT AS step_order, a.step AS event_type, a.events_ AS events, coalesce(a.sessions, 0)::BIGINT AS sessions,
       coalesce(a.people, 0)::BIGINT AS customers, {pct('a.events_', 'b.events_', 1, 0, 0)} AS pct_of_previous
FROM n a LEFT JOIN n b ON b.pos = a.pos - 1
""")

# Sessions walk along their own sorted times of each step.
ORACLE["c6_funnel_sessions"] = _q(_STEPS + """,
s AS (SELECT sid, list(ts ORDER BY ts) FILTER (step = 'pageview') AS a, list(ts ORDER BY ts) FILTER (step = 'add_to_cart') AS b,
             list(ts ORDER BY ts) FILTER (step = 'checkout') AS c, list(ts ORDER BY ts) FILTER (step = 'purchase') AS d
      FROM visit WHERE sid IS NOT NULL GROUP BY sid),
s1 AS (SELECT *, a[1] AS ta FROM s),
s2 AS (SELECT *, list_filter(b, lambda x: x >= ta)[1] AS tb FROM s1),
s3 AS (SELECT *, list_filter(c, lambda x: x >= tb)[1] AS tc FROM s2),
s4 AS (SELECT *, list_filter(d, lambda x: x >= tc)[1] AS td FROM s3),
n AS (SELECT [count(ta), count(tb), count(tc), count(td)] AS n FROM s4)
SELECT pos::BIGINT AS step_order, step AS event_type, n[pos] AS sessions_reached, """
                                + pct("n[pos]", "CASE WHEN pos > 1 THEN n[pos - 1] END", 1, 0, 0) + " AS pct_of_previous, "
                                + pct("n[pos]", "n[1]", 1, 0, 0) + """ AS pct_of_first
FROM steps, n
""")

ORACLE["c8_order_arithmetic_check"] = _q(_TABLES + "\nUNION ALL\n".join([
    _rule("net_equals_gross_minus_discount", "fact_orders", "net_revenue",
          "SELECT count(*) FROM t_fact_orders WHERE net_revenue <> gross_revenue"),
    _rule("item_count_equals_lines", "fact_orders", "item_count",
          "SELECT count(*) FROM t_fact_orders WHERE item_count <> coalesce(lines, 0)"),
    _rule("order_has_lines", "fact_orders", "order_id", "SELECT count(*) FROM t_fact_orders WHERE lines IS NULL"),
    _rule("margin_equals_revenue_minus_cost", "fact_order_items", "line_margin",
          "SELECT count(*) FROM t_fact_order_items WHERE line_margin <> line_revenue - line_cost"),
]))

# A customer's channel changes; all up to a day as a list, the latest first.
_FEED = """
feed AS (
  SELECT who, DATE '1992-01-01' AS day, -1 AS seq, segment AS channel FROM person
  UNION ALL
  SELECT who, day, okey, 'channel-' || priority[1:1] FROM sale WHERE status = 'refunded' AND who IS NOT NULL AND day IS NOT NULL)
"""
ORACLE["t1_channel_at_order_time"] = _q(_FEED + f""",
own AS (SELECT okey, any_value(d.money) AS money, any_value(d.day) AS day, list(f.channel ORDER BY f.day DESC, f.seq DESC)[1] AS channel
        FROM done d LEFT JOIN feed f ON f.who = d.who AND f.day <= d.day GROUP BY okey)
SELECT channel AS acquisition_channel, count(*) AS orders, sum(money)::DOUBLE AS revenue,
       {hu('sum(money)', 'count(money)', 2, 2, 0)} AS avg_order_value, min(day) AS first_order_date, max(day) AS last_order_date
FROM own GROUP BY channel
""")

ORACLE["t2_orders_after_first"] = _q("""
g AS (SELECT who, min(day) AS f FROM done WHERE who IS NOT NULL GROUP BY who),
w AS (SELECT unnest([30, 60, 90]) AS n)
SELECT n::BIGINT AS window_days, count(DISTINCT g.who) AS total_customers, count(DISTINCT o.who) AS returning_customers,
       count(o.okey) AS orders, coalesce(sum(o.money), 0)::DOUBLE AS revenue
FROM w CROSS JOIN g LEFT JOIN done o ON o.who = g.who AND o.day > f AND o.day <= f + n::INTEGER GROUP BY n
""")

ORACLE["t3_channel_history"] = _q(_FEED + """,
one AS (SELECT who, day, list(channel ORDER BY seq DESC)[1] AS channel FROM feed GROUP BY who, day),
l AS (SELECT who, list(day ORDER BY day) AS ds, list(channel ORDER BY day) AS cs FROM one GROUP BY who),
k AS (SELECT who, ds, cs, list_filter(range(1, len(ds) + 1), lambda i: i = 1 OR cs[i] IS DISTINCT FROM cs[i - 1]) AS heads FROM l),
v AS (SELECT who, ds, cs, heads, unnest(range(1, len(heads) + 1)) AS n FROM k)
SELECT who AS customer_key, n AS version, cs[heads[n]] AS acquisition_channel, ds[heads[n]] AS effective_date,
       ds[heads[n + 1]] AS expiry_date, n = len(heads) AS is_current
FROM v
""")

ORACLE["t4_running_revenue"] = _q("""
SELECT okey AS order_key, who AS customer_key, day AS order_date, money::DOUBLE AS net_revenue,
       sum(money) OVER (PARTITION BY who ORDER BY day, okey ROWS UNBOUNDED PRECEDING)::DOUBLE AS customer_revenue,
       row_number() OVER (PARTITION BY who ORDER BY day, okey) AS customer_orders,
       sum(money) OVER (ORDER BY day, okey ROWS UNBOUNDED PRECEDING)::DOUBLE AS total_revenue
FROM done
""")

# T5: windows are joins of days.
ORACLE["t5_revenue_last_days"] = _q(f"""
d AS (SELECT priority[1:1]::INTEGER AS ch, day, sum(money) AS rev, count(*) AS n FROM done GROUP BY ALL),
w AS (SELECT a.ch, a.day, any_value(a.rev) AS rev, sum(b.rev) AS s, sum(b.n) AS n, count(*) AS days
      FROM d a JOIN d b ON a.ch = b.ch AND b.day BETWEEN a.day - 6 AND a.day GROUP BY a.ch, a.day)
SELECT ch AS channel_key, day AS order_date, rev::DOUBLE AS revenue, s::DOUBLE AS revenue_last_days, n::BIGINT AS orders_last_days,
       days AS days_with_orders, {hu('s', 'days', 2, 2, 0)} AS avg_daily_revenue
FROM w
""")

# A session opens at an event without another of the user in the 720 minutes before it.
ORACLE["t6_session_funnel"] = _q(_STEPS + """,
seen AS (SELECT * FROM visit WHERE who IS NOT NULL AND ts IS NOT NULL),
heads AS (SELECT a.who, a.ts FROM seen a WHERE NOT EXISTS (
  SELECT 1 FROM seen b WHERE b.who = a.who AND b.ts < a.ts AND b.ts >= a.ts - INTERVAL 720 MINUTE) GROUP BY ALL),
walk AS (SELECT e.step, e.ts, e.who, max(h.ts) AS head FROM seen e JOIN heads h ON h.who = e.who AND h.ts <= e.ts GROUP BY e.ekey, e.step, e.ts, e.who),
s AS (SELECT who, head, list(ts ORDER BY ts) FILTER (step = 'pageview') AS a, list(ts ORDER BY ts) FILTER (step = 'add_to_cart') AS b,
             list(ts ORDER BY ts) FILTER (step = 'checkout') AS c, list(ts ORDER BY ts) FILTER (step = 'purchase') AS d
      FROM walk GROUP BY who, head),
s1 AS (SELECT *, a[1] AS ta FROM s),
s2 AS (SELECT *, list_filter(b, lambda x: x >= ta)[1] AS tb FROM s1),
s3 AS (SELECT *, list_filter(c, lambda x: x >= tb)[1] AS tc FROM s2),
s4 AS (SELECT *, list_filter(d, lambda x: x >= tc)[1] AS td FROM s3),
n AS (SELECT [count(ta), count(tb), count(tc), count(td)] AS n FROM s4)
SELECT pos::BIGINT AS step_order, step AS event_type, n[pos] AS sessions_reached, """
                               + pct("n[pos]", "CASE WHEN pos > 1 THEN n[pos - 1] END", 1, 0, 0) + " AS pct_of_previous, "
                               + pct("n[pos]", "n[1]", 1, 0, 0) + """ AS pct_of_first
FROM steps, n
""")

# Distinct counts straight from the lines, level by level.
ORACLE["t7_distinct_rollup"] = _q("""
b AS (SELECT d.day, date_trunc('month', d.day)::DATE AS month, kind, d.okey, d.who FROM line JOIN good USING (pkey) JOIN done d USING (okey))
SELECT 'day and category' AS level, day AS period, kind AS category, count(DISTINCT okey) AS orders, count(DISTINCT who) AS customers FROM b GROUP BY day, kind
UNION ALL SELECT 'month and category', month, kind, count(DISTINCT okey), count(DISTINCT who) FROM b GROUP BY month, kind
UNION ALL SELECT 'month', month, NULL, count(DISTINCT okey), count(DISTINCT who) FROM b GROUP BY month
UNION ALL SELECT 'all', NULL, NULL, count(DISTINCT okey), count(DISTINCT who) FROM b HAVING count(*) > 0
""")

# Every pair is counted.
ORACLE["t8_top_product_pairs"] = _q(f"""
b AS (SELECT DISTINCT okey, pkey FROM line WHERE okey IS NOT NULL AND pkey IS NOT NULL),
h AS (SELECT pkey, count(*) AS n FROM b GROUP BY pkey),
p AS (SELECT a.pkey AS pa, b.pkey AS pb, count(*) AS n FROM b a JOIN b ON a.okey = b.okey AND a.pkey < b.pkey GROUP BY ALL
      ORDER BY n DESC, pa, pb LIMIT 20)
SELECT pa AS product_a, pb AS product_b, p.n AS orders, x.n AS orders_a, y.n AS orders_b,
       {pct('p.n', 'least(x.n, y.n)', 1, 0, 0)} AS pct_of_rarer
FROM p JOIN h x ON x.pkey = pa JOIN h y ON y.pkey = pb
""")

# Places in sorted lists.
def _place(num: int, den: int) -> str:
    at, rest = f"({num} * (n - 1)) // {den}", f"({num} * (n - 1)) % {den}"
    return (f"((v[1 + {at}] * {den} + (v[1 + {at} + (CASE WHEN {rest} > 0 THEN 1 ELSE 0 END)] - v[1 + {at}]) * ({rest}))::DOUBLE"
            f" / {den * 100}::DOUBLE)")


ORACLE["t9_order_value_quartiles"] = _q(f"""
s AS (SELECT kind, okey, (sum(rev) * 100)::BIGINT AS c FROM line JOIN good USING (pkey) GROUP BY kind, okey),
l AS (SELECT kind, count(c) AS n, list(c ORDER BY c) AS v FROM s WHERE c IS NOT NULL GROUP BY kind)
SELECT kind AS category, n AS orders, {_place(1, 4)} AS quartile_1, {_place(1, 2)} AS median, {_place(3, 4)} AS quartile_3,
       {_place(99, 100)} AS percentile_99
FROM l
""")
