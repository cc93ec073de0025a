"""Item and event queries on our invented fixtures, checked against brute force."""

from collections import Counter, defaultdict
from decimal import Decimal
from itertools import combinations

from tillsight.operators import affinity, funnel, revenue
from tillsight.sources import fixtures as fx


def half_up(x: Decimal, digits: int) -> float:
    from decimal import ROUND_HALF_UP
    return float(x.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def _items():
    return [dict(zip(["item_key", "order_id", "product_key", "quantity", "unit_price",
                      "discount_pct", "line_revenue", "line_cost", "line_margin"], r))
            for r in fx.INVENTED_ITEM_ROWS]


def _products(invented=False):
    src = fx.DIM_PRODUCT_ROWS + (fx.INVENTED_PRODUCT_ROWS if invented else [])
    return {r[0]: {"name": r[2], "category": r[3], "brand": r[5]} for r in src}


def test_category_margin(sample):
    prods = _products()
    agg = defaultdict(lambda: {"orders": set(), "units": 0, "rev": Decimal(0),
                               "cost": Decimal(0), "margin": Decimal(0)})
    for i in _items():
        if i["product_key"] not in prods:
            continue
        a = agg[prods[i["product_key"]]["category"]]
        a["orders"].add(i["order_id"])
        a["units"] += i["quantity"]
        a["rev"] += Decimal(str(i["line_revenue"]))
        a["cost"] += Decimal(str(i["line_cost"]))
        a["margin"] += Decimal(str(i["line_margin"]))
    got = {r.category: r.asDict() for r in revenue.category_margin(sample.items,
                                                                    sample.products).collect()}
    assert set(got) == set(agg)
    for cat, a in agg.items():
        g = got[cat]
        assert g["orders"] == len(a["orders"]) and g["units_sold"] == a["units"]
        assert g["revenue"] == float(a["rev"]) and g["gross_margin"] == float(a["margin"])
        exp = None if a["rev"] == 0 else half_up(100 * a["margin"] / a["rev"], 1)
        assert g["margin_pct"] == exp
    assert got["Toys"]["margin_pct"] is None  # zero revenue: NULLIF guard


def test_top_products_rank_ties(sample):
    r = [x.asDict() for x in revenue.top_products(sample.items, sample.products, k=10).collect()]
    by_name = {x["product_name"]: x for x in r}
    # products 13 and 14 tie on revenue (139.00): same rank, next rank skips
    assert by_name["Kindle Paperwhite"]["revenue_rank"] == by_name["Air Fryer XL"]["revenue_rank"]
    ranks = [x["revenue_rank"] for x in r]
    assert ranks == sorted(ranks)
    revs = [x["revenue"] for x in r]
    for i, x in enumerate(r):
        assert x["revenue_rank"] == 1 + sum(v > x["revenue"] for v in revs)
    assert r[0]["product_name"] == "Yoga Mat Pro" and r[0]["revenue"] == 343.20


def test_product_affinity(sample):
    prods = _products(invented=True)
    lines = [(i["order_id"], i["product_key"]) for i in _items()]
    counts = Counter()
    for (o1, p1), (o2, p2) in ((a, b) for a in lines for b in lines):
        if o1 == o2 and p1 < p2:
            counts[(prods[p1]["name"], prods[p2]["name"])] += 1
    got = {(r.product_a, r.product_b): r.times_bought_together
           for r in affinity.product_affinity(sample.items, sample.products_plus, k=15).collect()}
    assert got == dict(counts)
    # the same product on two lines pairs twice with the other product of the order
    assert got[("Nike Air Max 270", "Instant Pot 7-in-1")] == 2
    # two products with one name merge into one name pair
    assert got[("Yoga Mat Pro", "Yoga Mat Pro")] == 1
    assert len([p for p in combinations([5, 11, 12], 2)]) == 3


def test_category_margin_share(sample):
    r = {x.category: x.asDict() for x in revenue.category_margin_share(
        sample.items, sample.products).collect()}
    total_orders = len({i["order_id"] for i in _items() if i["product_key"] in _products()})
    for cat, x in r.items():
        assert x["order_share_pct"] == half_up(Decimal(100 * x["orders"]) / total_orders, 1)


def test_funnel_counts(sample):
    r = [x.asDict() for x in funnel.funnel_counts(sample.events).collect()]
    ev = Counter(e[3] for e in fx.INVENTED_EVENT_ROWS)
    assert [x["event_type"] for x in r] == list(funnel.STEPS)
    assert [x["events"] for x in r] == [ev[s] for s in funnel.STEPS]
    assert r[0]["pct_of_previous"] is None
    assert r[3]["pct_of_previous"] == half_up(Decimal(100 * ev["purchase"]) / ev["checkout"], 1)
    assert r[0]["sessions"] == 7 and r[0]["customers"] == 6


def test_funnel_sessions(sample):
    r = [x.asDict() for x in funnel.funnel_sessions(sample.events).collect()]
    # s1, s6 complete; s4 skips checkout; s5's cart precedes its pageview
    assert [x["sessions_reached"] for x in r] == [7, 4, 2, 2]
    assert [x["pct_of_first"] for x in r] == [100.0, 57.1, 28.6, 28.6]
    assert [x["pct_of_previous"] for x in r] == [None, 57.1, 50.0, 100.0]
