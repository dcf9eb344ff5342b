"""What the item-grain and order-grain shuffles carry: keys and base columns, nothing that can be
summed elsewhere or derived after the joins."""

from __future__ import annotations

import re

import pytest

from fulcrum.operators import scoring, star
from tests.helpers import item, order, sources


@pytest.fixture
def static_joins(spark):
    """Plans as they are for tables that no join broadcasts."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _source(spark, items):
    return sources(spark, [order(o) for o in ("o1", "o2")], items, products=[("p1", "a", 1, 1, 1, 1)])


ITEMS = [item("o1", 1, "p1", "s1", price=5), item("o1", 2, "p1", "s2", price=7), item("o2", 1, "p1", "s1", price=9)]


def _plan(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def test_order_supplier_level_is_shuffled_as_bare_keys(spark, static_joins):
    st = star.Star(_source(spark, ITEMS))
    for df in (st.orders, star.order_value(st.src.order_items)):
        lines = _plan(df)
        at = [i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\(order_id#\d+, (supplier|seller)_id#", line)]
        assert all("functions=[]" in lines[i + 1] for i in at), "\n".join(lines)


def test_derived_columns_are_not_shuffled(spark, static_joins):
    lines = _plan(star.Star(_source(spark, ITEMS)).orders)
    below = "\n".join(lines[next(i for i, line in enumerate(lines) if "Exchange" in line):])
    assert "datediff" not in below and "date_format" not in below, below


def test_order_summary_meets_pairs_in_one_exchange(spark, static_joins):
    st = star.Star(_source(spark, ITEMS), materialize=True)
    keys = [m for line in _plan(scoring.supplier_base(st.links, st.orders, st.lines))
            for m in re.findall(r"Exchange hashpartitioning\(((?:_oid|order_id)#\d+(?:, order_month#\d+)?), \d+\)", line)]
    assert len(keys) == 2 and not any("order_month" in k for k in keys), keys


def test_items_without_an_order_count_their_suppliers(spark):
    items = ITEMS + [item(None, i, "p1", s, price=1) for i, s in enumerate(("s1", "s2", "s2", None))]
    got = {r.order_id: (float(r.revenue), r.n_items, r.n_suppliers) for r in star.order_value(_source(spark, items).order_items).collect()}
    assert got == {"o1": (12.0, 2, 2), "o2": (9.0, 1, 1), None: (4.0, 4, 2)}


def test_supplier_money_covers_items_outside_the_fact(spark):
    src = _source(spark, ITEMS + [item("gone", 1, "p1", "s1", price=100), item(None, 1, "p1", "s1", price=1000)])
    st = star.Star(src)
    a, b = (sorted((r.supplier_id, r.orders, float(r.revenue), float(r.freight)) for r in scoring.supplier_base(*args).collect())
            for args in ((st.links, st.orders, st.lines), (st.pairs, st.orders)))
    assert a == b and [(r[0], r[1], r[2]) for r in a] == [("s1", 2, 1114.0), ("s2", 1, 7.0)]
