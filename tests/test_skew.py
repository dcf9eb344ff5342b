"""Hot keys: one order and one supplier hold a large share of the lines; results must be
whole and exact (checked against a brute-force computation in Python)."""

from __future__ import annotations

from collections import defaultdict
from decimal import Decimal

from fulcrum.operators import scoring, star
from tests.helpers import item, order, sources


def test_hot_order_and_hot_supplier(spark):
    orders = [order("hot")] + [order(f"o{i}") for i in range(60)]
    items = [item("hot", i, f"p{i % 7}", f"s{i % 40}", price=1 + (i * 37) % 101, freight=0.5) for i in range(400)]
    items += [item(f"o{i}", 1, "p1", "s0", price=5 + i, freight=1.0) for i in range(60)]  # s0 also hot
    products = [(f"p{i}", f"cat{i % 3}", 1, 1, 1, 1) for i in range(7)]
    src = sources(spark, orders, items, products=products)
    st = star.Star(src)
    fact = {r.order_id: r for r in st.orders.collect()}

    by_order = defaultdict(list)
    for it in items:
        by_order[it[0]].append(it)
    for oid, lines in by_order.items():
        r = fact[oid]
        assert r.n_items == len(lines)
        assert r.n_suppliers == len({ln[3] for ln in lines})
        assert r.revenue == sum(ln[4] for ln in lines)
        best = min(lines, key=lambda ln: (-ln[4], ln[1], ln[3], ln[2]))
        assert r.primary_supplier_id == best[3]

    base = {r.supplier_id: r for r in scoring.supplier_base(st.pairs, st.orders).collect()}
    rev = defaultdict(Decimal)
    orders_of = defaultdict(set)
    for it in items:
        rev[it[3]] += it[4]
        orders_of[it[3]].add(it[0])
    assert set(base) == set(rev)
    for sid, r in base.items():
        assert r.revenue == rev[sid] and r.orders == len(orders_of[sid])
